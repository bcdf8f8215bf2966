"""Column functions (JVM-side expressions) and small driver-side distribution tails."""
