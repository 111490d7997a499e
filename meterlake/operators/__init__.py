"""DataFrame -> DataFrame operators, one module per analysis stage."""
