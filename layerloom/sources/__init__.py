"""Readers: relational imports, text layout, change-log topics, field lists, sample data."""
