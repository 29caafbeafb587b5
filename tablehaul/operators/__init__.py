"""Relational operators: projections, filters, synthesis, set ops, partition planning."""
