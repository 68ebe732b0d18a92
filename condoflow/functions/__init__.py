"""Column functions: every one is a composition of JVM-side Spark built-ins."""
