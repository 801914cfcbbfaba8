"""Readers, dated snapshots, payload flattening and writers."""
