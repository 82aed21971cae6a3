"""Composed stages and the registered query catalogue."""
