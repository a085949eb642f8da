"""Retail warehouse operators for Spark: change routing, dimensions, orders, wide lines, brand sums, search."""
