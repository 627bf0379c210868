"""Column expressions: text to number, labels, ranges, dates and rule tables."""
