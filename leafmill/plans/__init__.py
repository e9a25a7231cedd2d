"""Operator chains: corpus building and question answering as batch jobs."""
