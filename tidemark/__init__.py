"""Point-in-time market-context marts as composable Spark DataFrame operators."""
