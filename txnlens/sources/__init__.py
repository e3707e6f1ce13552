"""Reading transactions from files, catalog tables and streams."""
