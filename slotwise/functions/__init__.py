"""Column expressions: no action, no shuffle, all inside whole-stage code generation."""
