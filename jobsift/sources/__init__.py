"""Listing files, the stored table and the search-term configuration."""
