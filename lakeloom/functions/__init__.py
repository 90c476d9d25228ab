"""Column functions shared by the operators and marts."""
