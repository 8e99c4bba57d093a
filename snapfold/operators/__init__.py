"""DataFrame -> DataFrame operators, with columns and rules as parameters."""
