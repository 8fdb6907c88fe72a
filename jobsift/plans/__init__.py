"""Composed plans: loading a batch of listing files, and the query catalog."""
