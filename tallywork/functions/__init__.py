"""Column helpers that stay inside the JVM, and the few vectorised UDFs."""
