"""Column expressions: scalars, robust statistics, folds."""
