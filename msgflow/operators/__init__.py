"""Relational operators over message frames."""
