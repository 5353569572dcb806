"""Column builders that stay inside whole-stage code generation."""
