"""Column expressions: ids, paths, text, times and predicates (JVM-side, no UDFs)."""
