"""Part of lexloom."""
