"""Job-run SLA analytics as PySpark DataFrame operators."""
