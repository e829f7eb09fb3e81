"""Weftline streaming."""
