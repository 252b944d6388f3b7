"""DataFrame -> DataFrame operators, all lazy and parameterised."""
