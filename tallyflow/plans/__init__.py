"""Plans: the reference's jobs as operator compositions, and the query catalog."""
