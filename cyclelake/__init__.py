"""Drying-cycle analytics on Spark: sources, contract checks, Bronze/Silver/Gold, oven state, orders, time series, streams."""
