"""Column builders: expressions over text, identifiers and codes, without UDFs."""
