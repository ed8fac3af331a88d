"""Inputs: usage-log / table / parquet / SQL-file scans, fixture derivations, result normalisation."""
