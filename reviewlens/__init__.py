"""Review-intelligence tables as composable PySpark DataFrame operators."""
