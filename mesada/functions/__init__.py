"""Column functions: text, dates, batch labels and business labels. No Python UDFs."""
