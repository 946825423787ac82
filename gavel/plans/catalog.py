"""All registered plans; importing this module fills the registry."""

from __future__ import annotations

from gavel.plans import (q_answers, q_assembly, q_extraction, q_judging, q_literals, q_prompts, q_sources, q_streaming, q_tables,  # noqa: F401
                         q_verdicts)
from gavel.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
