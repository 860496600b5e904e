"""Whole jobs a user calls."""
