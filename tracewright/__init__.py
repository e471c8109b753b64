"""Process intelligence over event logs, expressed as Spark DataFrame plans."""

from tracewright.log import ProcessLog
from tracewright.operators.contracts import ContractError

__all__ = ["ContractError", "ProcessLog"]
__version__ = "0.1.0"
