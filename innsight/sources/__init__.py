"""Reading and writing review tables, and the small place tables."""
