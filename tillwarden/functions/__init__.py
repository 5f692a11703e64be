"""Column functions: no actions, no shuffles, JVM expressions only."""
