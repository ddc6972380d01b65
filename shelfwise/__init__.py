"""Retail demand and inventory analytics as lazy Spark DataFrame operators."""
