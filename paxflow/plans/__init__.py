"""Physical layouts shared by the operators: staged tables, row blocks, sliding frames."""
