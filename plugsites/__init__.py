"""Charging-site registry on Spark: several public feeds in, one row per site out."""
