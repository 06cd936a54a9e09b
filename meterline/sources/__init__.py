"""Reading months and zones, writing tables."""
