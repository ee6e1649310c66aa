"""Sources: all-text tables, storage listings, per-file headers, JSON pages, rule files, derived test shapes."""
