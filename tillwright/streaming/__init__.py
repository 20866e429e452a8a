"""Curation of orders that keep arriving."""
