"""Column functions: owners, units, rounding, positions, strips."""
