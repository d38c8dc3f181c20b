"""Column functions: text, dates and numbers."""
