"""Weftline operators."""
