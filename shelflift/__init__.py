"""Promotion and customer analytics for grocery loyalty data, written as Spark DataFrame operators."""
