"""Column expressions: no shuffles, no actions, no Python workers."""
