"""Marts, reports and the full refresh."""
