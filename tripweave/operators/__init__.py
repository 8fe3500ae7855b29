"""DataFrame -> DataFrame operators, one module per processing stage."""
