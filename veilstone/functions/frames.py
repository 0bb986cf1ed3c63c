"""Helpers for frames whose keys may be very uneven."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exploded(df: DataFrame, array: str | Column, name: str, *keep: str) -> DataFrame:
    """One row per array element.

    The outer form plus a later filter keeps Catalyst from copying the array expression into a filter below the
    explode, which would compute an expensive array twice.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is costly to compute.

    Catalyst moves filters below projections and copies the expressions they need, so a filter on anything
    derived from the column would compute it twice. It does not look through an explode, here of one element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on `keys` where NULL meets NULL, as it does in windows and groups. The keys of `left` stay."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys])
    return left.join(named, same, "left").drop(*[f"_right_{k}" for k in keys])


@dataclass(frozen=True)
class Running:
    """One running value, up to this row or the one before.

    Kinds: `count`, `sum`, `max`, `last` (latest non-null) and `first` (value of the very first row, NULL or not).
    `sparse` says that nearly all values are NULL, so that their bucket totals are worth a pass of their own.
    """

    kind: str
    value: Column | None = None
    before: bool = False
    sparse: bool = False


def hours(ts: Column, width: int = 1) -> Column:
    """Time bucket of `width` hours, for `running`."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / (3600 * width))


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, values: Mapping[str, Running]
) -> DataFrame:
    """Running values per key in `order`, without giving one key to one task.

    A plain window would sort a key's whole history in one task. Here rows are windowed per (key, bucket), the
    buckets are summarised with partial aggregation, the summaries are carried forward per key, and each bucket
    starts from what it was handed. `bucket` must not decrease along `order`.
    """
    parts = {name: _parts(r, order) for name, r in values.items()}
    slot = [*keys, "_bucket"]
    marked = df.withColumns({"_bucket": bucket, **{f"_in_{name}": p.value for name, p in parts.items()}})

    inner = Window.partitionBy(*slot).orderBy(*order)
    frames = {
        before: inner.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)
        for before in (False, True)
    }
    local = marked.withColumns(
        {f"_at_{name}": p.running(F.col(f"_in_{name}")).over(frames[values[name].before]) for name, p in parts.items()}
    )
    totals = _bucket_totals(marked, slot, values, parts)
    past = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *slot, *[p.carried(F.col(f"_all_{name}")).over(past).alias(f"_from_{name}") for name, p in parts.items()]
    )
    joined = null_safe_join(local, carried, slot)
    kept = [c for c in df.columns if c not in values]
    return joined.select(
        *kept, *[p.joined(F.col(f"_at_{name}"), F.col(f"_from_{name}")).alias(name) for name, p in parts.items()]
    )


def _bucket_totals(
    marked: DataFrame, slot: Sequence[str], values: Mapping[str, Running], parts: Mapping[str, _Parts]
) -> DataFrame:
    """What each bucket hands on. The latest of struct values needs sorted input to aggregate; for sparse ones only
    the few rows that have a value are sorted, and all rows just name their bucket by hash aggregation."""
    sparse = [name for name, r in values.items() if r.kind == "last" and r.sparse]
    dense = [name for name in values if name not in sparse]

    def total(name: str) -> Column:
        return parts[name].total(F.col(f"_in_{name}")).alias(f"_all_{name}")

    totals = marked.groupBy(*slot).agg(*[total(name) for name in dense]) if dense else marked.select(*slot).distinct()
    for name in sparse:
        few = marked.where(F.col(f"_in_{name}").isNotNull()).groupBy(*slot).agg(total(name))
        totals = null_safe_join(totals, few, slot)
    return totals


@dataclass(frozen=True)
class _Parts:
    """How one running value comes about: in its bucket, per bucket, across buckets, and put together."""

    value: Column
    running: Callable[[Column], Column]
    total: Callable[[Column], Column]
    carried: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]


def _parts(r: Running, order: Sequence[str]) -> _Parts:
    value = F.lit(1) if r.value is None else r.value
    if r.kind in ("count", "sum"):
        zero = F.lit(0)
        return _Parts(value, F.sum, F.sum, F.sum, lambda at, past: F.coalesce(at, zero) + F.coalesce(past, zero))
    if r.kind == "max":
        return _Parts(value, F.max, F.max, F.max, lambda at, past: F.greatest(at, past))
    if r.kind == "last":
        newest = lambda c: F.last(c, ignorenulls=True)
        return _Parts(
            value,
            newest,
            lambda c: F.max_by(c, F.when(c.isNotNull(), F.struct(*order))),
            newest,
            lambda at, past: F.coalesce(at, past),
        )
    if r.kind == "first":
        # A struct around the value keeps a NULL in the first row apart from no row at all.
        return _Parts(
            F.struct(value.alias("v")),
            F.first,
            lambda c: F.min_by(c, F.struct(*order)),
            lambda c: F.first(c, ignorenulls=True),
            lambda at, past: F.coalesce(past, at)["v"],
        )
    raise ValueError(f"unknown kind {r.kind}")


def hot_keys(counts: DataFrame, key: str, n: str, share: float = 0.001) -> DataFrame:
    """Keys that hold more than `share` of all rows: at most 1/share of them, so safe to broadcast."""
    total = counts.select(F.sum(n)).scalar()
    return counts.where(F.col(n) > total * F.lit(share)).select(key)


def skew_safe_lookup(
    big: DataFrame, small: DataFrame, counts: DataFrame, key: str, row_id: str, n: str = "n", salts: int = 64
) -> DataFrame:
    """Left join of `big` to `small`, whose `key` is unique, where a few keys may hold most rows of `big`.

    Rows of hot keys are spread over `salts` copies of their one small row; all other rows join plainly.
    """
    hot = F.broadcast(hot_keys(counts, key, n).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(salts))).otherwise(F.lit(0))
    left = big.join(hot, key, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"], "left").drop("_salt")
