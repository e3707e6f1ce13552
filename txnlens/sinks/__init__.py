"""Writing tables and alerts."""
