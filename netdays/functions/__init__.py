"""Column expressions: keys, payment terms, dates, money and code decoding."""
