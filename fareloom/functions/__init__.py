"""Column expressions: everything stays inside whole-stage codegen, no Python workers."""
