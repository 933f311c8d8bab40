"""Column expressions. All are JVM-side; none calls Python per row."""
