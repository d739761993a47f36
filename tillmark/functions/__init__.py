"""Column helpers: dates, money, text and sort order."""
