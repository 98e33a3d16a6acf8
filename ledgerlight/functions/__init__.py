"""Column expressions: no jobs, no state, everything stays inside the JVM."""
