"""Daily product recommendations as Spark DataFrame operators."""
