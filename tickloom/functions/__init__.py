"""Column -> Column functions; all run inside whole-stage code generation."""
