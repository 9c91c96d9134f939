"""Area definitions and the plans that produce the output tables."""
