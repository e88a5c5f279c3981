"""Readers: match dump, JSON messages, keyed tables, cluster lookup, event log."""
