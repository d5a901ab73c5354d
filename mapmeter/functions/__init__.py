"""Column builders: every function takes Columns and returns a Column evaluated inside the JVM."""
