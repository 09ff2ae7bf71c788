"""Column expressions over text: no shuffles, no Python workers."""
