"""Governed metrics: one definition, computed at the right grain."""
