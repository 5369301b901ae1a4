"""Part of lakequery."""
