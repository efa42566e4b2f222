"""Raw documents to encoded training text, in five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns what the next one reads. All but the last return the columns of docs, whatever
their names: the operators see docs under inner names, so no column can clash with one of theirs. Columns other than doc_id,
text, source and n_chars are only carried. An empty table gives an empty one at every stage.
SQL can express neither the models nor the hashes, so ORACLE_SQL is None; tests hold each stage's rows against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dualpath.llm import bpe, common, mixing, near_copies, simhash, substring, toxicity


class Inner:
    """docs under inner names, and back."""

    def __init__(self, docs: DataFrame):
        self.carried = common.Carried(docs, docs.columns)
        self.df = self.carried.take(docs)
        self.names = dict(zip(self.carried.names, self.carried.inner))

    def back(self, df: DataFrame) -> DataFrame:
        return df.select(*self.carried.back())


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Without labels of both classes none does.

    Null and empty texts are scored as texts without toxic windows, and stay. Null ids teach nothing. Of repeated rows all go or
    stay. The model is fitted to this stage's docs and the table of labels.
    """
    own = Inner(docs)
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return own.back(toxicity.score(own.df, own.carried.inner, model, own.names["text"]).filter("predicted = 0").drop("score", "predicted"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near fingerprints or by shingle similarity of 0.8 or more one stays, the one with the smallest id.

    SimHash links fingerprints within 3 bits, as op6 does; near_copies adds the pairs that such a radius misses.

    Null texts and texts without words are copies of each other. Null ids come last; of rows with the same id and different
    texts in one group the one with the smaller hash of the text stays, of repeated rows any one.
    """
    own = Inner(docs)
    near = simhash.merged(simhash.near_dedup(docs), near_copies.near_copies(docs))
    return own.back(simhash.one_of_each(own.df, near, own.names["doc_id"], own.names["text"]))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that stand elsewhere too go, and n_chars follows; all documents stay.

    Null texts stay null, texts without words become empty. Repeated rows are each other's copies. Kept words are joined by one
    space.
    """
    own = Inner(docs)
    text, size = own.names["text"], own.names.get("n_chars")
    rest = [c for c in own.carried.inner if c not in (text, size)]
    flagged = own.df.withColumn("_none", F.col(text).isNull())
    cut = substring.dedup(flagged, [*rest, "_none", *([size] if size else [])], text)
    cut = cut.withColumn(text, F.when(~F.col("_none"), F.col("kept_text")))
    if size:
        cut = cut.withColumn(size, F.length(text).cast(docs.schema["n_chars"].dataType))
    return own.back(cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have no words and are not taken. A null source is a source of its own, the last; null ids are values
    like any other. Repeated rows are taken alike. The same docs give the same mix.
    """
    own = Inner(docs)
    ids, text, source = (own.names[c] for c in ("doc_id", "text", "source"))
    return own.back(mixing.take(own.df, mixing.mix(own.df, ids, text, source), ids, text, source))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, encoded and decoded again.

    Null and empty texts have no ids. Null ids and repeated rows give a row each.
    """
    files = common.tokenizer_path("byte_bpe_50k.tiktoken"), common.pattern()
    # Written between, so that a task holds one tokenizer and not two.
    encoded = common.written(bpe.encode_texts(docs, ["doc_id"], *files), "ids")
    return bpe.digests(bpe.decode_ids(encoded, ["doc_id", "ids"], *files), ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("mix", mix_sources),
    ("byte_bpe", encode_bytes),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents. What a stage has read is removed once its own rows are written."""
    docs = common.table(common.tune(spark), sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        out = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        if at:
            common.discard(docs)
        docs = out
    return docs
