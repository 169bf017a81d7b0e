"""Operators over the content store."""
