"""All registered queries (importing this module registers them)."""

from __future__ import annotations

from scrutiny.harness import jobs, landing, logs, primitives, reports, streams  # noqa: F401
from scrutiny.harness.registry import QUERIES

__all__ = ["QUERIES"]
