"""Column expressions: casting, keys, tenors, money and option formulas."""
