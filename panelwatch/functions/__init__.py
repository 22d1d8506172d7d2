"""Column expressions; all run inside generated JVM code."""
