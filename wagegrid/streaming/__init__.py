"""Micro-batch loading of postings."""
