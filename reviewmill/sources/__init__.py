"""Readers for feeds and for the tables this package writes."""
