"""Readers: zip packages, lookup tables, name lists."""
