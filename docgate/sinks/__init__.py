"""Writers: insert-only tables, audit rows, dead letters, dated NDJSON."""
