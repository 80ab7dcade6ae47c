"""Registered queries."""

from tidemark.plans import derived, queries  # noqa: F401
