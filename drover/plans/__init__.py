from drover.plans.registry import queries, entry
from drover.plans.oracle import oracle_sql

__all__ = ["queries", "entry", "oracle_sql"]
