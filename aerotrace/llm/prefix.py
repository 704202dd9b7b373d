"""Distributed prefix sums (shared helper)."""

from aerotrace.operators.prefix import running_sums

__all__ = ["running_sums"]
