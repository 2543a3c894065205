"""Continuous forms: landing of live records and event-time results."""
