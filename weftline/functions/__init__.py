"""Weftline functions."""
