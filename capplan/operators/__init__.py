"""Table-level operators the area plans are composed of."""
