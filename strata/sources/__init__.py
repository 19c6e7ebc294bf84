"""Sources: raw envelope files, layer tables, the driver's tables."""
