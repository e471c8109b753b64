"""Multi-operator plans: the full analysis, its report, and the query registry."""
