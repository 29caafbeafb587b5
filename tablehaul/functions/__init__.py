"""Column-level functions: type normalisation rules, CSV/dynamic type resolution, SQL functions."""
