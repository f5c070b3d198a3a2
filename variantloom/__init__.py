"""Variant-to-evidence analytics as composable PySpark DataFrame operators."""
