"""Registered queries: importing this package fills the catalog."""

from cartwheel.plans import (cf_plans, encode_plans, model_plans, recall_plans, sampling_plans,  # noqa: F401
                             stream_plans, table_plans)
from cartwheel.plans.catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
