"""Reusable plan shapes: deterministic ranking, top-k, blocked scoring."""
