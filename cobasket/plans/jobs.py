"""Dated batch runs: choose inputs, compute, write one generation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, types as T

from cobasket.plans.similar_items import order_suggestions, purchase_suggestions
from cobasket.schemas import schema_of
from cobasket.sources.dumps import output_path, read_json, write_json, write_json_by_client
from cobasket.sources.snapshots import GENERATION_FORMAT, latest_generation_path, month_paths
from cobasket.tuning import ORDER_TUNING, PURCHASE_TUNING, Tuning


@dataclass(frozen=True)
class Mode:
    algorithm: str
    event_fields: tuple[str, ...]
    tuning: Tuning
    suggest: Callable[[DataFrame, DataFrame, Tuning], DataFrame]


# The directory of each mode's output.
MODES = {
    "purchase": Mode("si-cf-purchase", ("client", "items", "user_id"), PURCHASE_TUNING, purchase_suggestions),
    "buyorder": Mode(
        "si-cf-buyorder", ("client", "order_id", "items", "user_id"), ORDER_TUNING, order_suggestions
    ),
}


# JSON readers parse all of a declared struct, so what no job uses is left out of the schema.
_UNUSED_ITEM_FIELDS = ("items.product.specs", "items.product.price")


@dataclass(frozen=True)
class InputPlan:
    """What a run reads and writes."""

    catalog_path: str
    catalog_schema: T.StructType
    event_paths: tuple[str, ...]
    event_schema: T.StructType
    output_path: str


def _mode(name: str) -> Mode:
    if name not in MODES:
        raise ValueError(f"unknown mode {name!r}; known are {sorted(MODES)}")
    return MODES[name]


def plan_inputs(
    spark: SparkSession,
    mode: str,
    catalog_root: str,
    events_root: str,
    output_root: str,
    reference: date | None = None,
    n_months: int = 1,
    generation: str | None = None,
) -> InputPlan:
    """Resolve paths and schemas without reading any data.

    The catalog is always the latest finished one; ``reference`` (today by default) selects months
    of events only. ``generation`` names the output and defaults to the current time.
    """
    chosen = _mode(mode)
    return InputPlan(
        latest_generation_path(spark, catalog_root, "products"),
        schema_of("catalog", "products", select=("client", "product_id", "status")),
        tuple(month_paths(spark, events_root, "buyorder", reference or date.today(), n_months)),
        schema_of("event", "buyorder", select=chosen.event_fields, drop=_UNUSED_ITEM_FIELDS),
        output_path(output_root, chosen.algorithm, generation or datetime.now().strftime(GENERATION_FORMAT)),
    )


def run_job(
    spark: SparkSession,
    mode: str,
    catalog_root: str,
    events_root: str,
    output_root: str,
    reference: date | None = None,
    n_months: int = 1,
    generation: str | None = None,
    dry_run: bool = False,
    by_client: bool = False,
    **overrides,
) -> InputPlan:
    """Compute the suggestions of one mode and write them as a generation.

    A dry run stops after resolving paths and schemas. ``overrides`` replace single tunings. The
    whole run is one lazy plan with one action, the write. ``by_client`` lays the output out by client, at the price of
    counting documents first.
    """
    chosen = _mode(mode)
    tuning = chosen.tuning.with_overrides(**overrides)
    inputs = plan_inputs(spark, mode, catalog_root, events_root, output_root, reference, n_months, generation)
    if not dry_run:
        products = read_json(spark, inputs.catalog_path, inputs.catalog_schema)
        events = read_json(spark, inputs.event_paths, inputs.event_schema)
        write = write_json_by_client if by_client else write_json
        write(chosen.suggest(products, events, tuning), inputs.output_path)
    return inputs
