"""Ordered per-key computations that survive a key holding a large part of all rows.

A plain window sends one key to one task. Here a measured count finds the keys too big for that. Their
rows, and only theirs, are range-partitioned along (key, order), and the partition they fall in is
their segment: of bounded size, however many rows a key has, and rising along the order, which also
places NULLs. Row frames then see the rows before their segment as extra "halo" rows; running values
add what earlier segments carried. With no hot key the plan is the plain window.

Such a step reads the hot rows twice. They are written to the shared folder before it, so a chain of
steps does not double their lineage each time and a lost executor costs only the current step. Split
the rows once before a chain; the other keys' rows are never written.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from dualpath.functions.numbers import MICRO, micros
from dualpath.session import written

DEFAULT_HOT_ROWS = 4_000_000
DEFAULT_MEASURE_BYTES = 256 * 1024 * 1024
BROADCAST_KEYS = 200_000  # hot keys; with more of them, joins on the key are salted
SALTS = 64

_SEG = "_segment"
_HALO = "_halo"


@dataclass(frozen=True)
class HotGroups:
    """The oversized keys, a table of one row each, and how many segments their rows make."""

    keys: tuple[str, ...]
    table: DataFrame
    n_keys: int
    segments: int


@dataclass(frozen=True)
class Split:
    """Rows of ordinary keys, and rows of hot keys with their segment (None without a hot key)."""

    rest: DataFrame
    big: DataFrame | None = None

    def merged(self) -> DataFrame:
        return self.rest if self.big is None else self.rest.unionByName(self.big.drop(_SEG))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Measurements of this process by plan: a query asks for the same input several times. An outdated
# entry costs balance, not rightness: any set of keys may be cut.
_MEASURED: OrderedDict[tuple, HotGroups | None] = OrderedDict()
_REMEMBERED = 64


def find_hot_groups(df: DataFrame, keys: Sequence[str], max_rows: int | None = None) -> HotGroups | None:
    """The keys of more than `max_rows` rows, whose rows are to be cut into segments of about that many.

    Input small enough for one task is not counted. Pass the frame before deduplication: its counts
    are an upper bound and only the key columns are read.
    """
    spark = df.sparkSession
    measure = int(spark.conf.get("spark.dualpath.measureBytes", str(DEFAULT_MEASURE_BYTES)))
    if estimated_bytes(df) <= measure:
        return None
    limit = max_rows or int(spark.conf.get("spark.dualpath.hotRows", str(DEFAULT_HOT_ROWS)))
    types = tuple(df.schema[k].dataType.simpleString() for k in keys)
    plan = (spark.sparkContext.applicationId, df.semanticHash(), tuple(keys), types, limit)
    if plan not in _MEASURED:
        _MEASURED[plan] = _measured(df, keys, limit)
        if len(_MEASURED) > _REMEMBERED:
            _MEASURED.popitem(last=False)
    return _MEASURED[plan]


def _measured(df: DataFrame, keys: Sequence[str], limit: int) -> HotGroups | None:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = written(counts.where(F.col("_n") > limit), "hot-keys")
    n_keys, n_rows = hot.agg(F.count(F.lit(1)), F.sum("_n")).first()
    return HotGroups(tuple(keys), hot.select(*keys), n_keys, math.ceil(n_rows / limit)) if n_keys else None


def _on_hot_keys(df: DataFrame, side: DataFrame, hot: HotGroups, how: str) -> DataFrame:
    """Join rows with a side of one row per hot key, without bringing the rows of a key together.

    A side of few keys is broadcast. Beyond that rows are dealt to salts and the side is repeated for each.
    """
    named = side.withColumnsRenamed({k: f"_key_{k}" for k in hot.keys})
    match = F.lit(True)
    for k in hot.keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    if hot.n_keys <= BROADCAST_KEYS:
        return df.join(F.broadcast(named), match, how).drop(*[f"_key_{k}" for k in hot.keys])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    dealt = named.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(dealt, match & (F.col("_salt") == F.col("_salt_of")), how)
    return joined.drop("_salt", "_salt_of", *[f"_key_{k}" for k in hot.keys])


def _halo_rows(cut: DataFrame, keys: Sequence[str], order: Sequence[Column], back: int) -> DataFrame:
    """For each segment, the `back` rows just before it, moved into it and marked.

    Each segment that holds rows gives its last `back`; a segment then takes the last `back` of all
    that the `back` segments before it gave. At most `back` rows per segment leave the first step.
    """
    by_segment = Window.partitionBy(*keys, _SEG)
    numbered = cut.withColumn("_at", F.row_number().over(by_segment.orderBy(*order)))
    tails = (
        numbered.withColumn("_size", F.count(F.lit(1)).over(by_segment))
        .where(F.col("_at") > F.col("_size") - back)
        .groupBy(*keys, _SEG)
        .agg(F.sort_array(F.collect_list(F.struct("_at", F.struct(*cut.columns).alias("_row")))).alias("_tail"))
    )
    before = Window.partitionBy(*keys).orderBy(_SEG).rowsBetween(-back, -1)
    given = F.flatten(F.collect_list("_tail").over(before))
    nearest = F.slice(given, F.greatest(F.size(given) - back + 1, F.lit(1)), back)
    return (
        tails.select(F.col(_SEG).alias("_to"), nearest.alias("_rows"))
        .select("_to", F.explode("_rows").alias("_r"))
        .select("_to", "_r._row.*")
        .withColumn(_SEG, F.col("_to"))
        .withColumn(_HALO, F.lit(True))
        .drop("_to")
    )


@dataclass(frozen=True)
class OrderedGroups:
    """Rows of each key in a total order, cut into segments where a key is hot.

    Every step takes a frame and returns one, or takes what split() made and returns the same kind.
    """

    keys: tuple[str, ...]
    order: tuple[Column, ...]
    hot: HotGroups | None = None

    def split(self, df: DataFrame) -> Split:
        """Ordinary and hot keys apart, for a chain of steps in this order."""
        if self.hot is None:
            return Split(df)
        big = _on_hot_keys(df, self.hot.table, self.hot, "left_semi")
        dealt = big.repartitionByRange(self.hot.segments, *self.keys, *self.order)
        return Split(
            _on_hot_keys(df, self.hot.table, self.hot, "left_anti"), dealt.withColumn(_SEG, F.spark_partition_id())
        )

    def _step(self, rows, plain: Callable[[DataFrame], DataFrame], cut: Callable[[DataFrame], DataFrame]):
        if not isinstance(rows, Split):
            return self._step(self.split(rows), plain, cut).merged()
        if rows.big is None:
            return Split(plain(rows.rest))
        big = written(rows.big, "segments")
        return Split(plain(rows.rest), cut(big))

    def _window(self, *extra: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *extra).orderBy(*self.order)

    def frames(self, rows, back: int, build: Callable[[WindowSpec], dict[str, Column]]):
        """Add columns whose row frames reach at most `back` rows back and none ahead."""

        def cut(big: DataFrame) -> DataFrame:
            both = big.withColumn(_HALO, F.lit(False)).unionByName(_halo_rows(big, self.keys, self.order, back))
            return both.withColumns(build(self._window(_SEG))).where(~F.col(_HALO)).drop(_HALO)

        return self._step(rows, lambda df: df.withColumns(build(self._window())), cut)

    def running(self, rows, measures: dict[str, tuple[str, Column | None]]):
        """Add running values from the first row of the key to the current one.

        A measure is ("count", None), ("sum", c), ("max", c) or ("last", c), the latest non-NULL.
        """

        def so_far(df: DataFrame, *extra: str) -> DataFrame:
            w = self._window(*extra).rowsBetween(Window.unboundedPreceding, 0)
            return df.withColumns({n: _running(kind, c, w) for n, (kind, c) in measures.items()})

        def cut(big: DataFrame) -> DataFrame:
            inner = big
            if any(kind == "last" for kind, _ in measures.values()):
                inner = inner.withColumn("_at", F.row_number().over(self._window(_SEG)))
            totals = inner.groupBy(*self.keys, _SEG).agg(
                *[_segment_total(kind, c).alias(n) for n, (kind, c) in measures.items()]
            )
            before = Window.partitionBy(*self.keys).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
            carried = totals.select(
                *[F.col(k).alias(f"_key_{k}") for k in self.keys],
                F.col(_SEG).alias("_of"),
                *[_carry(kind, F.col(n), before).alias(f"_c_{n}") for n, (kind, _) in measures.items()],
            )
            # On (key, segment): no task meets more than a segment.
            match = F.col(_SEG) == F.col("_of")
            for k in self.keys:
                match = match & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
            joined = so_far(big, _SEG).join(carried, match, "left")
            return joined.withColumns(
                {n: _combine(kind, F.col(n), F.col(f"_c_{n}")) for n, (kind, _) in measures.items()}
            ).drop("_of", *[f"_key_{k}" for k in self.keys], *[f"_c_{n}" for n in measures])

        return self._step(rows, so_far, cut)

    def means_of(self, rows, measures: dict[str, Column], flag: Column):
        """Add, to every row of a key, the means over its flagged rows (a few per key)."""
        picked = {n: F.when(flag, micros(c)) for n, c in measures.items()}
        unit = F.lit(float(MICRO))

        def plain(df: DataFrame) -> DataFrame:
            w = Window.partitionBy(*self.keys)
            return df.withColumns({n: F.sum(c).over(w) / (F.count(c).over(w) * unit) for n, c in picked.items()})

        def cut(big: DataFrame) -> DataFrame:
            flagged = big.where(flag).groupBy(*self.keys)
            side = flagged.agg(*[(F.sum(c) / (F.count(c) * unit)).alias(n) for n, c in picked.items()])
            return _on_hot_keys(big, side, self.hot, "left")

        return self._step(rows, plain, cut)

    def maxima_of(self, rows, measures: dict[str, Column]):
        """Add, to every row of a key, maxima over all its rows."""

        def plain(df: DataFrame) -> DataFrame:
            w = Window.partitionBy(*self.keys)
            return df.withColumns({n: F.max(c).over(w) for n, c in measures.items()})

        def cut(big: DataFrame) -> DataFrame:
            side = big.groupBy(*self.keys).agg(*[F.max(c).alias(n) for n, c in measures.items()])
            return _on_hot_keys(big, side, self.hot, "left")

        return self._step(rows, plain, cut)


def _running(kind: str, c: Column | None, w: WindowSpec) -> Column:
    if kind == "count":
        return F.count(F.lit(1)).over(w)
    if kind == "sum":
        return F.sum(c).over(w)
    if kind == "max":
        return F.max(c).over(w)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(w)
    raise ValueError(f"unknown running measure {kind!r}")


def _segment_total(kind: str, c: Column | None) -> Column:
    if kind == "count":
        return F.count(F.lit(1))
    if kind == "sum":
        return F.sum(c)
    if kind == "max":
        return F.max(c)
    return F.max_by(c, F.when(c.isNotNull(), F.col("_at")))


def _carry(kind: str, total: Column, before: WindowSpec) -> Column:
    if kind in ("count", "sum"):
        return F.sum(total).over(before)
    if kind == "max":
        return F.max(total).over(before)
    return F.last(total, ignorenulls=True).over(before)


def _combine(kind: str, local: Column, carried: Column) -> Column:
    if kind in ("count", "sum"):
        both = F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        return F.when(local.isNotNull() | carried.isNotNull(), both)
    if kind == "max":
        return F.greatest(local, carried)
    return F.coalesce(local, carried)
