"""Helpers that shape the physical plan: sessions, lineage cuts, skew-safe windows."""
