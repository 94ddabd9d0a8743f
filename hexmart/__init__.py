"""hexmart: geographic data marts on a hierarchical hexagon grid, as PySpark plans."""
