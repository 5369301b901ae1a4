"""Training-data pipeline operators. Nothing else in lakequery imports this subpackage."""
