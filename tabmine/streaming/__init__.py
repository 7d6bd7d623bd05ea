"""Structured Streaming use of the stateless operators.

The reference has no streaming; the row functions (C1-C11) and the per-row
cleaning flags are plain Column expressions, so they run unchanged on a
streaming DataFrame."""

from tabmine.streaming.derived import derive_encounters, start_derived_stream  # noqa: F401
