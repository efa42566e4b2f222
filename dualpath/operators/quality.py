"""Data checks as small result tables, and the split of bad rows from good."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.schemas import required_fields


def _result(df: DataFrame, check: str, subject: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        F.lit(subject).alias("subject"),
        F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"),
    )


def column_checks(
    df: DataFrame, table: str, not_null: Sequence[str] = (), allowed: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """NULL counts and values outside closed vocabularies, all in one pass over the table."""
    checks = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    checks += [
        ("allowed_values", c, F.count_if(~F.col(c).isin(*values))) for c, values in (allowed or {}).items()
    ]
    counts = df.agg(*[violations.alias(f"_{i}") for i, (_, _, violations) in enumerate(checks)])
    named = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(f"{table}.{c}").alias("subject"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, (check, c, _) in enumerate(checks)
        ]
    )
    return counts.select(F.explode(named).alias("r")).select("r.*")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; counted in each map task first."""
    held = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_held"))
    return held.where(F.col("_held") > 1).withColumnRenamed("_held", "n")


def unique(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    found = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations"))
    return _result(found, "unique", f"{table}({','.join(keys)})")


def references(child: DataFrame, column: str, parent: DataFrame, key: str, subject: str) -> DataFrame:
    """Child rows whose value no parent holds. Values are counted before the join, so none is hot."""
    held = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_held"))
    lost = held.join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")
    return _result(lost.agg(F.sum("_held").alias("violations")), "references", subject)


@dataclass(frozen=True)
class TableChecks:
    """What to check of one table. `refers` names columns by the subject of a reference, `serves` the keys that answer it."""

    name: str
    df: DataFrame
    not_null: Sequence[str] = ()
    allowed: dict[str, Sequence[str]] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    refers: dict[str, str] = field(default_factory=dict)
    serves: dict[str, str] = field(default_factory=dict)

    def subjects(self) -> list[tuple[str, str]]:
        return [
            *[("not_null", f"{self.name}.{c}") for c in self.not_null],
            *[("allowed_values", f"{self.name}.{c}") for c in self.allowed],
            *[("unique", f"{self.name}({','.join(keys)})") for keys in self.unique],
            *[("references", subject) for subject in self.refers],
        ]

    def tagged(self) -> DataFrame:
        """check_name, subject, key, held, known: what each row says to each check, in one pass over the table."""

        def says(check: str, subject: str, key: Column, held: int = 1) -> Column:
            return F.struct(
                F.lit(check).alias("check_name"), F.lit(subject).alias("subject"), key.cast("string").alias("key"),
                F.lit(held).cast("bigint").alias("held"), F.lit(1 - held).alias("known"),
            )

        none = F.lit(None)
        tags = [F.when(F.col(c).isNull(), says("not_null", f"{self.name}.{c}", none)) for c in self.not_null]
        tags += [F.when(~F.col(c).isin(*v), says("allowed_values", f"{self.name}.{c}", none)) for c, v in self.allowed.items()]
        for keys in self.unique:
            # Values of several columns are told apart by their lengths, NULLs by having none.
            parts = [F.col(c).cast("string") for c in keys]
            whole = F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
            tags.append(says("unique", f"{self.name}({','.join(keys)})", whole))
        tags += [F.when(F.col(c).isNotNull(), says("references", subject, F.col(c))) for subject, c in self.refers.items()]
        tags += [F.when(F.col(c).isNotNull(), says("references", subject, F.col(c), 0)) for subject, c in self.serves.items()]
        return self.df.select(F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t")).select("t.*")


def one_pass(tables: Sequence[TableChecks]) -> DataFrame:
    """check_name, subject, violations of all checks, each table read once.

    Rows become tagged keys that are counted in map tasks first, so no key is hot; a row per check keeps those that find nothing.
    Repeated keys, rows of keys that no parent has, NULLs and values outside a vocabulary are counted as by the single checks.
    """
    spark = tables[0].df.sparkSession
    asked = [(check, subject, None, 0, 0) for t in tables for check, subject in t.subjects()]
    seeds = spark.createDataFrame(asked, "check_name string, subject string, key string, held bigint, known int")
    rows = reduce(DataFrame.unionByName, [t.tagged() for t in tables], seeds)
    keys = rows.groupBy("check_name", "subject", "key").agg(F.sum("held").alias("held"), F.max("known").alias("known"))
    found = (
        F.when(F.col("check_name") == "unique", (F.col("held") > 1).cast("bigint"))
        .when(F.col("check_name") == "references", F.when(F.col("known") == 0, F.col("held")).otherwise(0))
        .otherwise(F.col("held"))
    )
    return keys.groupBy("check_name", "subject").agg(F.sum(found).alias("violations"))


def observed(df: DataFrame, name: str, checks: dict[str, Column]) -> DataFrame:
    """df, which reports with each batch its rows and how many violate each check; a stream's progress carries them."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(n) for n, bad in checks.items()])


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Columns the entity needs and the frame lacks."""
    return [f.name for f in schema if f.name not in df.columns]


def valid_row(schema: T.StructType, allowed_values: dict[str, list[str]]) -> Column:
    """True where all required columns are set and closed vocabularies hold."""
    names = {f.name for f in schema}
    rules = [F.col(c).isNotNull() for c in required_fields(schema)]
    rules += [F.col(c).isin(*v) for c, v in allowed_values.items() if c in names]
    return F.coalesce(reduce(lambda a, b: a & b, rules), F.lit(False))


def quarantine_split(
    df: DataFrame, schema: T.StructType, allowed_values: dict[str, list[str]]
) -> tuple[DataFrame, DataFrame]:
    """Good rows and the rows to set aside."""
    ok = valid_row(schema, allowed_values)
    return df.where(ok), df.where(~ok)


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
