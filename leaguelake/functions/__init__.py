"""Column expressions: derivations, local time, message text."""
