"""Column expressions: ``Column -> Column``, all inside the JVM."""
