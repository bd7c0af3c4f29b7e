"""Readers and writers for posting tables."""
