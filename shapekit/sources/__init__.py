"""Readers and writers: parquet tables, tolerant CSV, tagged text, stored
outputs, the error ledger, and the JSON/CSV sinks."""
