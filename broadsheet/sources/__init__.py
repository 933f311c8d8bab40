"""Readers and writers: feeds, pages, JSON stores, messages, stored windows, run files."""
