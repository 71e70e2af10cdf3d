"""Column functions: calendar windows, grid cells, physical formulas."""
