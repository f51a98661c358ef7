"""Run logs as streams."""
