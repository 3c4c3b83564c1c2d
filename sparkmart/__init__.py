"""Weekly cohort analytics as Spark DataFrame, SQL and MLlib operators."""
