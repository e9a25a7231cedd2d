"""Readers and adapters that bring files, landed tables and turns into one contract."""
