"""Retail analytics on Spark: dated snapshots in, star schema, gates and KPIs out."""

__version__ = "0.1.0"
