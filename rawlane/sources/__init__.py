"""Reading: the file manifest and delimited text."""
