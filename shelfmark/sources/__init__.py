"""Readers of landing files, raw pages, raw responses and layer tables."""
