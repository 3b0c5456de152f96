"""Column-level helpers; everything here stays inside generated JVM code."""
