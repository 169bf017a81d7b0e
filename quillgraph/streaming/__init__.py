"""Streaming counterparts."""
