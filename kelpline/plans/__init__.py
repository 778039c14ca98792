"""Ordered steps: enrichment, restriction, publishing."""
