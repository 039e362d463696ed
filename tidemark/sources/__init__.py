"""Getting records in and out: files, change events, tagged JSON, the log store."""
