"""Readers: tables, partitioned folders, JSON files, stream envelopes."""
