"""Retail sales analytics on Spark: warehouse load, rollup, reports, elasticity, databook."""
