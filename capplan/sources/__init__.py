"""Readers of simulation folders and reference lookups."""
