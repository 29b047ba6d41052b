"""Relational operators over page, record, frontier, response and master tables."""
