"""Whole jobs: sync, preflight, handover, monitoring."""
