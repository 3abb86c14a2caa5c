"""Registered queries over the data folders and their DuckDB oracles."""
