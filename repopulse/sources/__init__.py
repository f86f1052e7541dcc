"""Reading and writing: hourly archives, the raw lake, the mart, the search index."""
