"""Readers: reference files, seeds, change events, distance answers, layer tables."""
