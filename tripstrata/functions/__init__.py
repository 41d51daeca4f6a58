"""Column expressions: typing, calendar, geometry and numeric helpers. No Python UDFs."""
