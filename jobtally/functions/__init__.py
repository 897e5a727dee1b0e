"""Column expressions: job rules, report calendar, exact rounding."""
