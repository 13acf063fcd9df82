"""Column helpers: text cleaning, keys, month arithmetic, ratios."""
