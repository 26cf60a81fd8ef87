"""Contract-cost, reconciliation, redaction and validation jobs as Spark DataFrame plans."""

__version__ = "0.1.0"
