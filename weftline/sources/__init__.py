"""Weftline sources."""
