"""Readers, writers and the adapters that shape tables into readings."""
