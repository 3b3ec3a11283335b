"""Item-to-item suggestions on Spark: which items are bought together, and how much it means."""

from cobasket.plans.jobs import InputPlan, plan_inputs, run_job
from cobasket.plans.similar_items import (
    order_suggestions,
    order_similar_items,
    purchase_suggestions,
    purchase_similar_items,
)
from cobasket.tuning import ORDER_TUNING, PURCHASE_TUNING, Tuning

__all__ = [
    "InputPlan",
    "ORDER_TUNING",
    "PURCHASE_TUNING",
    "Tuning",
    "order_suggestions",
    "order_similar_items",
    "plan_inputs",
    "purchase_suggestions",
    "purchase_similar_items",
    "run_job",
]
