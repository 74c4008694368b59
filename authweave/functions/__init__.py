"""Column expressions: map-only, JVM-side."""
