"""What the operators share: carried columns, sizes, written tables, tokenizer files."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.session import new_run_dir

WORD = r"[^\x20\x09-\x0D]+"

# Text rows are large: batches handed to Python stay small whatever the row count.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends there and lost executors cost nothing."""
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables made by written() that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(conf).delete(path, True)


def text_bytes(df: DataFrame, col: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0


def pieces(total: float, each: float, least: int = 1) -> int:
    return max(least, math.ceil(total / each))


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Carried:
    """Columns that ride along under names that can't clash with an operator's own."""

    def __init__(self, df: DataFrame, cols: list[str]):
        self.names = cols
        self.fields = [T.StructField(f"_c{i}", df.schema[c].dataType) for i, c in enumerate(cols)]

    @property
    def inner(self) -> list[str]:
        return [f.name for f in self.fields]

    def take(self, df: DataFrame, **own: Column) -> DataFrame:
        """Own columns first, then the carried ones. Names with dots or quotes are fine."""
        quoted = ["`" + c.replace("`", "``") + "`" for c in self.names]
        return df.select(
            *[c.alias(name) for name, c in own.items()], *[F.col(q).alias(i) for q, i in zip(quoted, self.inner)]
        )

    def schema(self, own: str) -> T.StructType:
        return T.StructType(self.fields + list(T.StructType.fromDDL(own)))

    def back(self) -> list[Column]:
        return [F.col(i).alias(name) for i, name in zip(self.inner, self.names)]


def map_texts(
    df: DataFrame, carried: Carried, own: str, make: Callable[[], Callable[[list], dict]], text: str = "_text"
) -> DataFrame:
    """Per batch: the list of texts goes in, a dict of columns (in the order of `own`) comes out.

    `make` runs once a task, so that models load there.
    """
    schema = carried.schema(own)
    names = carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        arrow = None
        for batch in batches:
            column = batch.column(text)
            out = work(arrays(column) if pa.types.is_list(column.type) else column.to_pylist())
            arrow = arrow or arrow_types(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [as_array(out[n], t) for n, t in arrow.items()],
                names=names + list(arrow),
            )

    return df.mapInArrow(run, schema)


def arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The rows of a column of numbers, null ones empty; as arrays they take a fifth of the memory of lists."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy()
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values
    return pa.array(values, type=kind)


SIMPLE = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
}


def arrow_types(ddl: str) -> dict[str, pa.DataType]:
    return {name: SIMPLE[kind] for name, kind in (part.strip().split(" ", 1) for part in ddl.split(","))}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, length of them, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def pattern() -> str:
    """The pre-token pattern of the byte-level ranks files."""
    import public_tokenizers

    return public_tokenizers.PATTERN
