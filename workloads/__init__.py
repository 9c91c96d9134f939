"""Queries over the driver tables: derived inputs, registered queries, oracle SQL."""
