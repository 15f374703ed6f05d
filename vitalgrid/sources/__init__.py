"""Reading and writing of source and derived tables."""
