"""Readers of pages, files and payloads."""
