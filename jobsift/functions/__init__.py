"""Column expressions: screening rules, text helpers, calendar helpers."""
