"""Incremental refresh of the boards as result pages arrive."""

from podium.streaming.refresh import refresh_boards  # noqa: F401
