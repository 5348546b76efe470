"""Column expressions: text, references, redaction, grounding, contamination."""
