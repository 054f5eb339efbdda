"""Reading, writing and describing landed files and layer tables."""
