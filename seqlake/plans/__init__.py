"""The jobs users call: ingests, catalog, analysis table, read export, submission checks."""
