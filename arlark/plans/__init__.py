"""Sinks, jobs, the query catalog and its oracle text."""
