"""Column expressions (JVM-side, no Python UDFs): predicates, classification, decimals, positions."""
