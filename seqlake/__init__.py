"""seqlake: a PySpark-native engine for a genomics results lake (catalog, analysis tables, ingests)."""
