"""Column functions: every one takes and returns Spark columns and runs in the JVM."""
