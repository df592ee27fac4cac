"""Queries bound to the driver's test tables, and their SQL oracles."""
