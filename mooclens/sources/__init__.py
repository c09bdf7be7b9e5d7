"""Inputs: the bridge from the driver tables, raw-file ingest jobs, table upkeep."""
