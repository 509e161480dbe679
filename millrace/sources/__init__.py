"""Readers. Each returns a DataFrame; what is read is decided on paths and schemas alone."""
