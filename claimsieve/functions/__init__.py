"""Column rules: every function maps a Column to a Column and runs inside the JVM."""
