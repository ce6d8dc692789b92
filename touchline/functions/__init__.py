"""Column expressions; all are JVM-side built-ins."""
