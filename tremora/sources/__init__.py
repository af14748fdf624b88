"""Reading and writing tables, feeds and streams."""
