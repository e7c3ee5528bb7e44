"""Column builders that stay in the JVM, and the few Arrow kernels."""
