"""Column expressions used inside the enrichment jobs."""
