"""Alerts on unbounded transactions."""
