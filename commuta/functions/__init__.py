"""Column expressions: arithmetic rules, recodes, geometry."""
