"""Operators composed into the silver, gold and validation stages."""
