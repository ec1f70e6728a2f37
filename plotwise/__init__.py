"""Property-listing analytics as composable Spark DataFrame operators."""
