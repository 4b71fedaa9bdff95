"""Column expressions: no actions, no shuffles, all inside whole-stage code generation."""
