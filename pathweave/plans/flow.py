"""The composed jobs (J1–J3).  One narrow stage: no shuffle, one parse per message."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once
from ..operators.dead_letters import accepted, dead_letters
from ..operators.flatten import INCLUDE, flatten_json, flatten_pages, item_leaves, with_counters
from ..operators.paginate import PageCheck, PageNames, paginate, split_to_json, without_originals
from ..operators.parse import parse_messages
from ..operators.transform import transform_fields
from ..operators.unflatten import document_plan, plan_error, unflatten
from ..operators.validate import validate_messages, validate_required
from . import rules


@dataclass(frozen=True)
class FlowConfig:
    """What a job does; ``array=None`` means flat messages."""

    required: Sequence[str] = ()
    array: str | None = None
    item_required: Sequence[str] = ()
    names: PageNames | None = None
    page_size: int = 100
    nulls: str = INCLUDE
    patterns: Sequence[str] = ()
    fn: Callable[[Column], Column] = field(default=F.upper)
    on_non_array: str = "dlq"

    @staticmethod
    def from_schemas(input_schema: rules.Schema, output_schema: rules.Schema | None = None, **options) -> FlowConfig:
        array = rules.array_field(input_schema)
        names = None
        if array is not None:
            names = PageNames(array) if output_schema is None else rules.page_names(output_schema)
        return FlowConfig(
            required=rules.required_paths(input_schema),
            array=array,
            item_required=rules.required_item_paths(input_schema),
            names=names,
            **options,
        )


def validate_split_flatten(df: DataFrame, cfg: FlowConfig) -> DataFrame:
    """Parse, validate, page and flatten in one pass (J2); failed rows carry ``error``."""
    df = validate_required(parse_messages(df), cfg.required)
    if cfg.array is None:
        return flatten_json(df, cfg.nulls)
    names = cfg.names or PageNames(cfg.array)
    pages = paginate(df, cfg.array, cfg.page_size, cfg.item_required, cfg.on_non_array, check=page_check(names, cfg.nulls))
    return flatten_pages(pages, names, cfg.nulls)


def page_check(names: PageNames, nulls: str = INCLUDE) -> PageCheck:
    """The errors that pages meet when they are flattened and put together again, for ``paginate(check=…)``.

    Changing values, as :func:`transform_fields` does, makes no difference to them; changing paths does.
    """

    def leaves(page: Column) -> Column:
        p, total, items, texts = (page.getField(f) for f in ("p", "total", "items", "texts"))
        return with_counters(p, total, F.size(items), item_leaves(items, texts, names, nulls), names)

    def check(df: DataFrame) -> DataFrame:
        # one step a column: a plan with fewer lambdas inside each other is analysed sooner
        df = once(df, drop=("_pages",), _flats=F.transform("_pages", leaves))
        df = once(df, drop=("_flats",), _plans=F.transform("_flats", lambda flat: F.when(flat.isNotNull(), document_plan(flat))))
        return once(df, drop=("_plans",), _errors=F.transform("_plans", plan_error))

    return check


def outcomes(df: DataFrame, cfg: FlowConfig) -> DataFrame:
    """All results of a job in one DataFrame: ``json``, or ``error`` and the message in ``value``, on every row.

    Writing it partitioned by outcome, or to Kafka with a topic per row, takes one pass over
    the source for results and dead letters together.
    """
    df = validate_split_flatten(df, cfg)
    if cfg.patterns:
        df = transform_fields(df, cfg.patterns, cfg.fn)
    return without_originals(unflatten(df).drop("flat"))


def run_flow(df: DataFrame, cfg: FlowConfig) -> tuple[DataFrame, DataFrame]:
    """``(results, dead letters)`` of a job.  Acting on both reads the source twice."""
    done = outcomes(df, cfg)
    return accepted(done), dead_letters(done)


def chained(df: DataFrame, cfg: FlowConfig) -> DataFrame:
    """Validate, split and flatten as three steps.

    Differs from :func:`validate_split_flatten`: one incomplete item rejects the whole message,
    rules look at direct children only, and the flattener is lenient.
    """
    array, names = cfg.array, cfg.names or PageNames(cfg.array)
    checked = validate_messages(parse_messages(df), array, cfg.required, cfg.item_required)
    pages = split_to_json(checked, array, cfg.page_size, names, cfg.on_non_array)
    earlier = pages.withColumnRenamed("error", "_failed")
    flat = flatten_json(
        parse_messages(earlier, lenient=True).withColumn("error", F.coalesce("_failed", "error")).drop("_failed"),
        cfg.nulls,
    )
    return flat
