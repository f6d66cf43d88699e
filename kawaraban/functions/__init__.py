"""Column functions: text, dates, links, case frames and HTML text."""
