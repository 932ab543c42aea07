"""Whole jobs: scan, operators, result tables."""
