"""churnlens: churn analytics over event logs, as Spark DataFrame operators."""
