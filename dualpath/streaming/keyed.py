"""Running values per key of a stream, on Spark's own state.

A key's rows of a micro-batch are put in order and continue what the rows before them left: a count, the last rows of some
columns, totals. That is all the state holds, so it is small whatever the stream's length, and Spark keeps it in its state
store, versioned by batch and restored after a crash. Sums are of whole numbers, so batching never changes them.
Rows that take the latest values of other streams wait in such a state too, until the watermark has passed them (see latest).

Spark hands Python the rows of a keyed state one by one. So they come packed: the rows of a key in an Arrow batch are one row
that holds them as an Arrow stream, and come out the same way.

The rows of a key in one micro-batch meet in one task. The source bounds what a micro-batch admits (see
sources.read_files), and with it what a task holds, also where most rows have one key.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


@dataclass(frozen=True)
class Running:
    """What to carry, by output name. All sources are BIGINT columns but those of `previous`.

    index: the row's number in its key, from 1. windows: (column, rows) sums over the last rows, with <name>_n their known
    values. gaps: the same of what the column grew since the row before. totals: sums of all rows so far. first: (column, rows) sums over the key's first rows, with <name>_n. previous:
    the column's value in the row before. highest: the largest value so far, this row's included.
    """

    index: str | None = None
    windows: dict[str, tuple[str, int]] = field(default_factory=dict)
    gaps: dict[str, tuple[str, int]] = field(default_factory=dict)
    totals: dict[str, str] = field(default_factory=dict)
    first: dict[str, tuple[str, int]] = field(default_factory=dict)
    previous: dict[str, str] = field(default_factory=dict)
    highest: dict[str, str] = field(default_factory=dict)

    def outputs(self, rows: T.StructType) -> T.StructType:
        counted = [n for name in (*self.windows, *self.gaps, *self.first) for n in (name, f"{name}_n")]
        longs = [*([self.index] if self.index else []), *counted, *self.totals, *self.highest]
        return T.StructType(
            [T.StructField(n, T.LongType()) for n in longs]
            + [T.StructField(n, rows[c].dataType) for n, c in self.previous.items()]
        )

    def state(self, rows: T.StructType) -> T.StructType:
        some = T.ArrayType(T.LongType())
        return T.StructType(
            [T.StructField("rows", T.LongType())]
            + [T.StructField(f"w{i}", some) for i in range(len(self.windows) + len(self.gaps))]
            + [T.StructField("sums", some)]
            + [T.StructField(f"p{i}", rows[c].dataType) for i, c in enumerate(self.previous.values())]
        )


# Rows of an output that are packed at a time.
CHUNK = 1 << 16


def _packed(rows: pa.Table, options: pa.ipc.IpcWriteOptions | None = None) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _pack(keys: list[str]):
    """Per batch: the rows of each key as one row, so that few rows pass the state's row by row way.

    Its key is text and never null: pandas would turn whole numbers beside a null into doubles, and a null into many keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            group = np.zeros(len(batch), np.int64)
            for key in keys:
                codes = batch.column(key).dictionary_encode("encode")
                group = group * len(codes.dictionary) + codes.indices.to_numpy()
                group = np.unique(group, return_inverse=True)[1]
            order = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            rows = pa.Table.from_batches([batch]).take(pa.array(order))
            data = [_packed(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(rows)])]
            first = rows.select(keys).take(pa.array(starts))
            names = [json.dumps(row, default=str) for row in zip(*(first.column(k).to_pylist() for k in keys))]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary())], names=["_key", "_rows"])

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for packed in batch.column(0):
            held.append(_unpacked(packed.as_py()))
            size += len(held[-1])
            if size >= CHUNK:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def _longs(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not values.null_count:
        return values.cast(pa.int64()).to_numpy(), np.ones(len(values), bool)
    known = values.is_valid().to_numpy(zero_copy_only=False)
    return values.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), known


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


class _Carry(StatefulProcessor):
    def __init__(self, spec: Running, order: list[str], keep: list[str], state: T.StructType, out: T.StructType, keep_ms: int | None):
        self.spec, self.order, self.keep, self.schema, self.out, self.keep_ms = spec, order, keep, state, out, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carried = handle.getValueState("carried", self.schema, ttlDurationMs=self.keep_ms)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pa.concat_tables([_unpacked(packed) for part in rows for packed in part.iloc[:, -1]])
        marks = [batch.column(c).to_numpy() for c in reversed(self.order)]
        batch = batch.take(pa.array(np.lexsort(marks))) if marks else batch
        out, after = self.continued(batch.combine_chunks(), self.carried.get() if self.carried.exists() else None)
        self.carried.update(after)
        for at in range(0, len(out), CHUNK):
            yield pd.DataFrame({"_rows": [_packed(out.slice(at, CHUNK))]})

    def continued(self, batch: pa.Table, was: tuple | None) -> tuple[pa.Table, tuple]:
        """The rows of a key, in order, with their values, and what they leave, from what the rows before them left."""
        spec, n = self.spec, len(batch)
        columns = {c: _one(batch.column(c)) for c in self.keep}
        longs: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def numbers(column: str) -> tuple[np.ndarray, np.ndarray]:
            if column not in longs:
                longs[column] = _longs(columns[column])
            return longs[column]

        seen = was[0] if was else 0
        frames = len(spec.windows) + len(spec.gaps)
        old = list(was[1 + frames]) if was else [0] * (len(spec.totals) + 2 * len(spec.first)) + [None] * len(spec.highest)
        number = seen + np.arange(1, n + 1)
        out, after, sums = dict(columns), [seen + n], []
        if spec.index:
            out[spec.index] = pa.array(number)
        for i, (name, (column, width)) in enumerate([*spec.windows.items(), *spec.gaps.items()]):
            tail = list(was[1 + i]) if was else []
            values, known = numbers(column)
            values = np.concatenate((np.array([v or 0 for v in tail], np.int64), values))
            known = np.concatenate((np.array([v is not None for v in tail], bool), known))
            held = width if name in spec.gaps else width - 1
            last = slice(max(0, len(values) - held), None)
            after.append([v if k else None for v, k in zip(values[last].tolist(), known[last].tolist())])
            if name in spec.gaps:
                known = np.concatenate(([False], known[1:] & known[:-1]))
                values = np.diff(values, prepend=0) * known
            at = len(tail) + np.arange(1, n + 1)
            for suffix, what in (("", values), ("_n", known.astype(np.int64))):
                run = np.concatenate(([0], np.cumsum(what)))
                out[name + suffix] = pa.array(run[at] - run[np.maximum(at - width, 0)])
        for name, column in spec.totals.items():
            run = old.pop(0) + np.cumsum(numbers(column)[0])
            out[name] = pa.array(run)
            sums.append(int(run[-1]))
        for name, (column, limit) in spec.first.items():
            values, known = numbers(column)
            early = number <= limit
            for suffix, what in (("", values * early), ("_n", (known & early).astype(np.int64))):
                run = old.pop(0) + np.cumsum(what)
                out[name + suffix] = pa.array(run)
                sums.append(int(run[-1]))
        for name, column in spec.highest.items():
            values, known = numbers(column)
            before, least = old.pop(0), np.iinfo(np.int64).min
            top = np.maximum.accumulate(np.where(known, values, least))
            top = top if before is None else np.maximum(top, before)
            out[name] = pa.array(top, mask=top == least)
            sums.append(None if top[-1] == least else int(top[-1]))
        after.append(sums)
        for i, (name, column) in enumerate(spec.previous.items()):
            own = columns[column]
            before = pa.array([was[2 + frames + i] if was else None], own.type)
            out[name] = pa.concat_arrays([before, own.slice(0, n - 1)])
            after.append(own[-1].as_py())
        return pa.table([out[c] for c in self.out.fieldNames()], self.out.fieldNames()), tuple(after)


def carry(stream: DataFrame, keys: list[str], order: list[Column], spec: Running, keep_ms: int | None = None) -> DataFrame:
    """The stream's rows with the values of `spec`, by the order that rows of one micro-batch have in their key.

    Rows of earlier micro-batches come first. `order` are numbers, rising; nulls come last. Null keys are a key. Whole numbers
    pass through Python exactly; those of `order` up to 2^53. With `keep_ms` the store drops keys that nothing is heard of for so long; such a query
    has a clock of its own and never ends by itself, so bounded runs go without.
    """
    keep = stream.columns
    marks = [f"_order{i}" for i in range(len(order))]
    dealt = stream.select("*", *[c.cast("double").alias(m) for c, m in zip(order, marks)])
    out = T.StructType([*stream.schema.fields, *spec.outputs(stream.schema).fields])
    processor = _Carry(spec, marks, keep, spec.state(stream.schema), out, keep_ms)
    grouped = dealt.mapInArrow(_pack(keys), "_key string, _rows binary").groupBy("_key")
    rows = grouped.transformWithStateInPandas(processor, "_rows binary", "Append", "ProcessingTime" if keep_ms else "None")
    return rows.mapInArrow(_unpack, out)


def _lz4(rows: pa.Table) -> bytes:
    return _packed(rows, pa.ipc.IpcWriteOptions(compression="lz4"))


class _Latest(StatefulProcessor):
    """Of a key: the rows that the watermark has not passed and the signals that may still count, as one Arrow stream."""

    def __init__(self, keep: list[str], keys: list[str], matches: list[list[str]], names: list[str], clock: str, within: int):
        self.keep, self.keys, self.matches, self.names, self.clock, self.within = keep, keys, matches, names, clock, within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary, timer bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pa.concat_tables([_unpacked(packed) for part in rows for packed in part.iloc[:, -1]])
        yield from self._advance(fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(None, timerValues.getCurrentWatermarkInMs())

    def _advance(self, fresh: pa.Table | None, watermark: int) -> Iterator[pd.DataFrame]:
        was = self.held.get()
        parts = [] if fresh is None else [self.on_time(fresh, watermark * 1000)]
        if was:
            parts.append(_unpacked(was[0]))
        if not parts:
            return
        out, held, due = self.passed(pa.concat_tables(parts), watermark * 1000)
        if was and was[1] != due and was[1] >= watermark:
            self.handle.deleteTimer(was[1])
        if due is None:
            self.held.clear()
        else:
            self.held.update((_lz4(held), due))
            if not was or was[1] != due:
                self.handle.registerTimer(due)
        for at in range(0, len(out), CHUNK):
            yield pd.DataFrame({"_rows": [_packed(out.slice(at, CHUNK))]})

    def on_time(self, fresh: pa.Table, upto: int) -> pa.Table:
        """Without what came too late, has no time, or is a signal whose key is null."""
        kind, known = fresh.column("_kind").to_numpy().astype(np.int64), fresh.column(self.clock).is_valid().to_numpy()
        clock = fresh.column(self.clock).fill_null(0).to_numpy()
        for column in self.keys:
            known &= (kind == 0) | fresh.column(column).is_valid().to_numpy()
        return fresh.filter(pa.array(known & (clock > upto - self.within * np.maximum(kind - 1, 0))))

    def passed(self, rows: pa.Table, upto: int) -> tuple[pa.Table, pa.Table, int | None]:
        """The rows that the watermark `upto` has passed, with their values; what is held on; when to look again, in ms."""
        rows = rows.group_by(rows.column_names).aggregate([]).combine_chunks()  # equal rows are one
        kind, clock = rows.column("_kind").to_numpy(), rows.column(self.clock).to_numpy()
        value, known = rows.column("_value").fill_null(0.0).to_numpy(), rows.column("_value").is_valid().to_numpy()
        wait = self.within * len(self.matches)
        own = kind == 0
        done = own & (clock <= upto - wait)
        out = {c: rows.column(c).filter(pa.array(done)) for c in self.keep}
        for n, (name, match) in enumerate(zip(self.names, self.matches), 1):
            out[name] = self.found(rows, match, done, kind == n, clock, value, known)
        waiting = own & ~done
        oldest = min(clock[waiting].min(), upto) if waiting.any() else upto
        stay = waiting | (~own & (clock >= oldest - self.within))
        # Spark calls for timers below the watermark, so this one is called once the watermark is at least its time and one ms.
        at = clock[waiting].min() + wait if waiting.any() else clock[stay].max() + self.within + 1 if stay.any() else None
        return pa.table(out), rows.filter(pa.array(stay)), None if at is None else int(-(-at // 1000)) - 1

    def found(self, rows: pa.Table, match: list[str], done: np.ndarray, signal: np.ndarray, clock, value, known) -> pa.Array:
        """For each done row the latest of the signal's values; of one time the largest, a null the least."""
        both = np.flatnonzero(done | signal)
        code, whole = np.zeros(len(both), np.int64), np.ones(len(both), bool)
        for column in match:
            codes = rows.column(column).take(pa.array(both)).combine_chunks()
            whole &= codes.is_valid().to_numpy(zero_copy_only=False)
            codes = codes.dictionary_encode("encode")
            code = np.unique(code * len(codes.dictionary) + codes.indices.to_numpy(), return_inverse=True)[1]
        order = np.lexsort((value[both], known[both], done[both], clock[both], code))
        at, code, whole = both[order], code[order], whole[order]
        last = np.maximum.accumulate(np.where(signal[at], np.arange(len(at)), -1))
        near = (last >= 0) & whole & (code == code[last]) & (clock[at] - clock[at[last]] <= self.within) & known[at[last]]
        back = done[at]
        rank = np.argsort(at[back], kind="stable")
        return pa.array(value[at[last]][back][rank], mask=~near[back][rank])


def latest(rows: DataFrame, signals: dict[str, tuple[DataFrame, list[str]]], keys: list[str], clock: str, within: int) -> DataFrame:
    """Rows with the latest value of each signal that is not after them and at most `within` microseconds before.

    `signals` has, by the name of a column of doubles, a stream and the columns that have to be equal besides `keys`. All
    streams have `clock`, in microseconds, and a watermark. A row comes out when the watermark has passed it by `within` for
    each signal; what is behind the watermark is left out, of the n-th signal what is behind by n - 1 times `within` more. So a
    row has seen all that may reach it. Equal rows are one, rows without a time never come out, and null keys equal nothing.

    The rows and signals of a key in one micro-batch meet in one task; rows with a null key are dealt by time.
    """
    keep = rows.columns
    unknown = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])
    spread = F.when(unknown, F.col(clock) - F.pmod(F.col(clock), F.lit(within)))
    met = rows.select(F.lit(0).alias("_kind"), *keep, F.lit(None).cast("double").alias("_value"), spread.alias("_spread"))
    for n, (name, (signal, match)) in enumerate(signals.items(), 1):
        own = [F.col(f.name) if f.name in (*keys, *match, clock) else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
        met = met.union(signal.select(F.lit(n).alias("_kind"), *own, F.col(name).cast("double").alias("_value"), spread.alias("_spread")))
    out = T.StructType([*rows.schema.fields, *[T.StructField(name, T.DoubleType()) for name in signals]])
    processor = _Latest(keep, keys, [match for _, match in signals.values()], list(signals), clock, within)
    grouped = met.mapInArrow(_pack([*keys, "_spread"]), "_key string, _rows binary").groupBy("_key")
    packed = grouped.transformWithStateInPandas(processor, "_rows binary", "Append", "EventTime")
    return packed.mapInArrow(_unpack, out)
