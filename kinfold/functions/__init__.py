"""Column expressions: missing-value rules, recodes, money and household formulas."""
