"""Column expressions the operators are made of. Nothing here starts a Spark job."""
