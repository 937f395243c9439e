"""All registered queries."""

from __future__ import annotations

from gondola.plans import q_cookbook, q_gold, q_records, q_silver  # noqa: F401
from gondola.plans.registry import plans, sql_texts

__all__ = ["plans", "sql_texts"]
