"""Column functions: every rule of the domain as a JVM-side expression."""
