"""Column-expression helpers: date text (styles, parsing, shifts, parts) and audience conditions."""
