"""Leaderboards and reports composed from the operators."""
