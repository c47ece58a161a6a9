"""Column expressions: text, numbers, dates and plug labels. All native Spark."""
