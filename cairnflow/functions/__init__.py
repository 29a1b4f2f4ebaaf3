"""Column functions: text and identifiers, floor labels, planar geometry, rings. All stay inside the JVM unless stated."""
