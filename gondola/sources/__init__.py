"""Reading and writing the catalogue's files."""
