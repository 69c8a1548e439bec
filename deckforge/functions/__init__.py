"""Column-level functions (JVM-side expressions, plus two Arrow UDFs)."""
