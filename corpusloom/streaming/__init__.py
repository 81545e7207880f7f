"""Counters over arriving documents."""
