"""Market-data operators, each a DataFrame to DataFrame function."""
