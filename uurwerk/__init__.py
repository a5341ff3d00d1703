"""Hourly energy analytics as composable PySpark DataFrame operators."""
