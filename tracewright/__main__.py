from tracewright.plans.run import main

raise SystemExit(main())
