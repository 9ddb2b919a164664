"""Relational operators over annotated documents."""
