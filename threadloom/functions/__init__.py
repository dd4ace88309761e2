"""Column builders: no UDF in any of them."""
