"""Lakeloom: composable Spark operators for a layered analytics lake."""
