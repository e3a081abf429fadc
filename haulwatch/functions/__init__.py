"""Column functions: geometry, time of day, bit fields."""
