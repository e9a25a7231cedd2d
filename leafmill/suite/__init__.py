"""Registered queries over the landed tables, each with an independent SQL form."""
