"""Watching registers that are published as full daily snapshots: change capture, matching, feeds, monitoring."""
