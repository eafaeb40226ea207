"""Range filters, declarative filters and the filter funnel."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from tidemark.functions import as_bound

Bound = dt.date | dt.datetime | str | None


def date_range(df: DataFrame, column: str, start: Bound = None, end: Bound = None) -> DataFrame:
    """Rows with ``start <= column <= end``; no bounds at all means no filter.

    One bound alone is rejected.  The column is compared as it is, so the bounds reach the
    file scan and skip row groups.
    """
    if start is None and end is None:
        return df
    if start is None or end is None:
        raise ValueError("a date range needs both a start and an end")
    return df.filter(F.col(column).between(as_bound(start), as_bound(end)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


@dataclass(frozen=True)
class FilterSpec:
    """One optional filter of a report: a range on a number or a flag to match."""

    label: str
    column: str
    kind: str                      # "range" or "flag"
    value: Any = None              # (low, high) or True/False
    enabled: bool = True

    def __post_init__(self):
        if self.kind not in ("range", "flag"):
            raise ValueError(f"unknown filter kind: {self.kind}")

    def predicate(self) -> Column:
        if self.kind == "range":
            low, high = self.value
            return F.col(self.column).between(low, high)
        return F.col(self.column) == F.lit(self.value)

    def text(self) -> str:
        """The predicate as SQL text."""
        if self.kind == "range":
            return "{} BETWEEN {!r} AND {!r}".format(self.column.lower(), *self.value)
        return f"{self.column.lower()} = {str(self.value).lower()}"


def enabled_filters(filters: Sequence[FilterSpec]) -> list[FilterSpec]:
    return [f for f in filters if f.enabled]


def apply_filters(df: DataFrame, filters: Sequence[FilterSpec]) -> DataFrame:
    """All enabled filters in declared order; Catalyst merges them into one scan predicate."""
    return reduce(lambda d, f: d.filter(f.predicate()), enabled_filters(filters), df)


#: Fixed values of the funnel's first and last label.
FIRST_LABEL, LAST_LABEL = "Original data", "Result"


def step_labels(filters: Sequence[FilterSpec]) -> list[str]:
    return [FIRST_LABEL, *[f"Filter: '{f.label}'" for f in enabled_filters(filters)], LAST_LABEL]


def filter_funnel(df: DataFrame, filters: Sequence[FilterSpec]) -> DataFrame:
    """Rows left after each enabled filter, as links between labelled steps.

    All steps are counted in one pass over the needed columns.
    """
    labels = step_labels(filters)
    predicates = [f.predicate() for f in enabled_filters(filters)]
    reached = [F.lit(True)] + [reduce(and_, predicates[: i + 1]) for i in range(len(predicates))]
    counts = df.agg(*[F.count_if(p).alias(f"s{i}") for i, p in enumerate(reached)])
    links = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(labels[i]).alias("source_label"),
                F.lit(labels[i + 1]).alias("target_label"),
                F.col(f"s{i}").alias("row_count"),
            )
            for i in range(len(reached))
        ]
    )
    return counts.select(F.inline(links))


def slider_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Option range 0..max for each numeric filter column, in one pass."""
    top = df.agg(*[F.max(c).alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.lit(0).cast("long").alias("low"),
                F.col(c).cast("long").alias("high"),
            )
            for c in columns
        ]
    )
    return top.select(F.inline(rows))


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def statement_sequence(df: DataFrame, filters: Sequence[FilterSpec]) -> list[tuple[int, str, str]]:
    """(number, label, plan text) for the table after each step."""
    enabled = enabled_filters(filters)
    steps = [apply_filters(df, enabled[:i]) for i in range(len(enabled) + 1)]
    return [
        (i + 1, label, plan_text(step))
        for i, (label, step) in enumerate(zip(step_labels(filters), steps))
    ]


def statement_texts(relation: str, filters: Sequence[FilterSpec]) -> list[tuple[int, str, str]]:
    """(number, label, SQL text) for the table after each step, each built on the one before.

    The texts run as they are where ``relation`` names a table, or as ``{relation}`` where a frame is passed.
    """
    text, out = f"SELECT * FROM {relation}", []
    for number, (label, spec) in enumerate(zip(step_labels(filters), [None, *enabled_filters(filters)]), 1):
        if spec is not None:
            text = f"SELECT * FROM ({text}) WHERE {spec.text()}"
        out.append((number, label, text))
    return out
