"""Column expressions: no I/O, no actions, all inside the JVM."""
