"""Table sources and inventories."""
