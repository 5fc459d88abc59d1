"""Column-level scalar functions (F*, P1, P9): all built-in JVM expressions."""
