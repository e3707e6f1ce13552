"""Reports and the runs that build the tables."""
