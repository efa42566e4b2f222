"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are each wanted target / size times: whole copies, and a fraction left to chance. The chance is
pivotal: two documents of a source with fractional mass (words) meet, and mass moves from one to the other, the way drawn
so that neither gains in the mean, until one is whole or empty. The sum of the mass never changes, so the words taken miss
the target by less than one document, the last.

Rows that are the same in id, source and text are one unit, so that their draws can't depend on their order.

Documents meet in a reduction tree. At each level those that are left in a source are dealt by a hash to groups of about
GROUP, each group is folded in an `aggregate` over its documents, largest first, and sends on the one that is still
fractional. A source that holds a third of all rows is thousands of groups. All draws are hashes of the document and the
level, so reruns agree whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualpath.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
GROUP = 32
RANGE = 1 << 53


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)).cast("long"), F.lit(0).cast("long"))


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, n_units, target: from rows (source, size, copies).

    Sources take the weights in turn, by code point, null last, and share `share` times all sizes; a target stops at
    `most` times its source's size and the excess is shared again among the rest.
    """
    totals = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_units")
    )
    # Places without one task for all sources: the rows of earlier partitions, and the place in the own one.
    at = F.monotonically_increasing_id()
    ordered = common.written(totals.orderBy(F.asc_nulls_last("source")).withColumn("at", at), "sources")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    earlier, seen = [], 0
    for row in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():  # one row a partition
        earlier += [F.lit(row["part"]), F.lit(seen)]
        seen += row["count"]
    if earlier:
        place = place + F.create_map(*earlier)[part]
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    weighed = ordered.select("source", "source_size", "n_units", weight.alias("weight"))
    level = _water_level(weighed, share, most)
    target = F.least(most * F.col("source_size").cast("double"), F.col("weight") * F.lit(level))
    return weighed.select("source", "source_size", "n_units", target.alias("target"))


def _water_level(weighed: DataFrame, share: float, most: float) -> float:
    """Words per unit of weight: raised until what targets at their limit give up is shared among the others."""
    cap = most * F.col("source_size")
    level = -1.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        total, held, weight = weighed.agg(
            F.sum("source_size"), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not weight or not total:
            return max(level, 0.0)
        raised = (share * total - float(held or 0)) / weight
        if raised <= level:
            return level
        level = raised


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(RANGE)) / F.lit(float(RANGE))


def _fold(units: Column, kind: str, level: Column) -> Column:
    """open: the one unit of a group that is still fractional, if any; done: the others, up telling how each was rounded.

    Of a meeting's two units a and b, mass goes to a (rises) or to b until one of them is whole or empty.
    """

    def settled(u: Column, is_settled: Column, up: Column) -> Column:
        row = F.struct(u.alias("unit"), up.alias("up"))
        return F.when(is_settled, F.array(row)).otherwise(F.array().cast(f"array<struct<unit:{kind},up:boolean>>"))

    def meet(state: Column, b: Column) -> Column:
        a = state["open"]
        gain, loss = F.least(a["size"] - a["mass"], b["mass"]), F.least(a["mass"], b["size"] - b["mass"])
        rises = _uniform(a["key"], b["key"], level) * (gain + loss) < loss
        a_done = F.when(rises, a["size"] - a["mass"] <= b["mass"]).otherwise(a["mass"] <= b["size"] - b["mass"])
        b_done = F.when(rises, b["mass"] <= a["size"] - a["mass"]).otherwise(b["size"] - b["mass"] <= a["mass"])
        a_left = a.withField("mass", F.when(rises, a["mass"] + gain).otherwise(a["mass"] - loss))
        b_left = b.withField("mass", F.when(rises, b["mass"] - gain).otherwise(b["mass"] + loss))
        left = F.when(a_done & b_done, F.lit(None).cast(kind)).when(a_done, b_left).otherwise(a_left)
        done = F.concat(state["done"], settled(a, a_done, rises), settled(b, b_done, ~rises))
        return F.struct(
            F.when(a.isNull(), b).otherwise(left).alias("open"),
            F.when(a.isNull(), state["done"]).otherwise(done).alias("done"),
        )

    none = F.array().cast(f"array<struct<unit:{kind},up:boolean>>")
    return F.aggregate(units, F.struct(F.lit(None).cast(kind).alias("open"), none.alias("done")), meet)


def row_key(docs: DataFrame, id_col: str, text: str, source: str) -> Column:
    """Tells rows apart that differ in id, source or text."""
    return F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in (id_col, source, text)])


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    group: int = GROUP,
) -> DataFrame:
    """doc_id, key, size, source_size, target, copies, taken: one row per row.

    size is the number of words, copies how often the mix takes the document (0 to `most`), taken = copies * size, and
    target its source's (see targets). A source's taken words miss its target by less than one unit's words. Null and
    empty texts have size 0 and are not taken; null ids and sources are values like any other; repeated rows are taken
    alike. An empty table gives an empty result. Other columns are not read. key is row_key(), to join texts by.
    """
    read = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        words(F.col(f"`{text}`")).alias("size"), row_key(docs, id_col, text, source).alias("key"),
    )
    rows = common.written(read.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("copies")), "sizes")
    wanted = targets(rows, weights, share, most)
    most_units = wanted.agg(F.max("n_units")).first()[0] or 0
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.withColumnRenamed("copies", "rows").join(
        wanted.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    )
    unit = F.struct(
        (F.col("size") * F.col("rows")).alias("size"), "key", "doc_id", "source", "rows", F.col("size").alias("words"),
        "source_size", "target", F.floor(ratio).alias("whole"),
        ((ratio - F.floor(ratio)) * F.col("size") * F.col("rows")).alias("mass"),
        F.ceil(F.col("n_units") / group).alias("groups"),
    )
    units = common.written(joined.select(unit.alias("unit")), "units")
    kind = units.schema["unit"].dataType.simpleString()
    fractional = F.col("unit.mass") > 0
    results = [units.filter(~fractional).select("unit", F.lit(False).alias("up"))]
    left, groups, level = units.filter(fractional), -(-most_units // group), 0
    while groups:
        bucket = F.pmod(F.xxhash64("unit.key", "unit.doc_id", F.lit(level)), F.col("unit.groups"))
        dealt = left.groupBy(F.col("unit.source").alias("source"), bucket.alias("bucket")).agg(
            F.reverse(F.array_sort(F.collect_list("unit"))).alias("units")
        )
        folded = common.written(dealt.select(_fold(F.col("units"), kind, F.lit(level)).alias("f")).select("f.*"), "fold")
        results.append(folded.select(F.explode("done").alias("d")).select("d.*"))
        left = folded.filter("open is not null").select(F.col("open").alias("unit"))
        last = F.col("unit.groups") == 1
        chance = _uniform(F.col("unit.key"), F.lit(-1)) * F.col("unit.size") < F.col("unit.mass")
        results.append(left.filter(last).select("unit", chance.alias("up")))
        fewer = F.ceil(F.col("unit.groups") / group)
        left = left.filter(~last).select(F.col("unit").withField("groups", fewer).alias("unit"))
        groups, level = (0 if groups == 1 else -(-groups // group)), level + 1
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    taken = out.select("unit.*", (F.col("unit.whole") + F.col("up").cast("long")).alias("copies"))
    each = taken.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select(
        "doc_id", "key", F.col("words").alias("size"), "source_size", "target", "copies",
        (F.col("copies") * F.col("words")).alias("taken"),
    )


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    copies = mixed.select(F.col("key").alias("_key"), F.col("doc_id").alias("_id"), "copies").distinct().filter("copies > 0")
    keyed = docs.withColumn("_own", row_key(docs, id_col, text, source))
    match = (F.col("_own") == F.col("_key")) & F.col(f"`{id_col}`").eqNullSafe(F.col("_id"))
    both = keyed.join(copies, match).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns])
