"""Landed captures into the snapshot store, incrementally."""
