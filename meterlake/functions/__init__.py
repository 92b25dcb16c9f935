"""Column-level functions; all of them compile into whole-stage code generation."""
