"""Operators composed into whole jobs and report tables."""
