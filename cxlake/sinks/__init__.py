"""Outputs: catalog tables (create, overwrite, append, merge, compact) and files."""
