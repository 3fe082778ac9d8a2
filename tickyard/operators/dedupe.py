"""Deduplication and distinct (U2, U3; batch form of U1).

``dedupe`` keeps exactly one row per key, chosen by a total order, with an
aggregate (``min_by``/``max_by`` over a struct) rather than a ranking window:
the aggregate is combined map-side, so a key that holds a large share of the
rows is reduced inside each input task before the shuffle, and no task ever
holds a whole key group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .bars import ORDER_COLS
from .tables import hashable, key_or_content

# Default key of a trade: producer id plus the day it belongs to is not needed;
# the (symbol, event_id) pair is unique by contract.
TRADE_KEY = ("symbol", "event_id")


def survivor_order(df: DataFrame, order: Sequence[str] = ORDER_COLS) -> Column:
    """Total order: the given columns first, then every other column."""
    rest = [c for c in df.columns if c not in order]
    form = dict(zip(df.columns, hashable(df.schema), strict=True))
    return F.struct(*[form[c] for c in list(order) + rest if c in form])


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER_COLS,
           keep: str = "first") -> DataFrame:
    """One row per key; ``keep='first'`` (earliest) or ``'last'`` (latest).

    A row with a NULL in its key has no identity and is matched by its whole
    content: only exact copies of it are removed."""
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    row = F.struct(*[F.col(c) for c in df.columns])
    pick = F.min_by if keep == "first" else F.max_by
    return (df.groupBy(*keys, key_or_content(keys, hashable(df.schema)).alias("_content"))
              .agg(pick(row, survivor_order(df, order)).alias("_row"))
              .select("_row.*"))


def deduplicate_trades(df: DataFrame, legacy_key: bool = False, keep: str = "first") -> DataFrame:
    """Trades deduplicated by (symbol, event_id), or by (symbol, timestamp)
    with ``legacy_key=True`` (that key merges distinct trades in one ms).

    The survivor is the first arrival (smallest ``processed_at``) when the
    frame carries it, then the earliest by (event_time, event_id, price,
    volume)."""
    keys = ("symbol", "timestamp") if legacy_key else TRADE_KEY
    order = tuple(dict.fromkeys(("processed_at", *ORDER_COLS)))
    return dedupe(df, keys, order, keep)


def distinct_buckets(df: DataFrame, cols: Sequence[str] = ("trade_year", "trade_month", "trade_day")
                     ) -> DataFrame:
    """The distinct bucket tuples (hash aggregate, partial map-side)."""
    return df.select(*cols).distinct()
