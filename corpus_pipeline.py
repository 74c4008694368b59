"""Cleaning a corpus: toxic documents go, near copies go, repeated passages go, the rest is
packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read back as the next stage's docs. All but the last keep the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from authweave.llm import ngram_join, packing, suffix_dedup, toxicity
from authweave.llm.tables import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; labels outside the held-out quarter are learned.

    Null texts are scored as empty, repeated rows stay repeated, columns of any name are kept as
    they are; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", F.struct("*").alias("row"))
    judged = toxicity.judge(rows, table(spark, sf_dir, "labels"))
    return judged.where("predicted = 0").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (75 % of five-word runs).

    Documents without words are no copies of each other; rows without an id all stay, as nothing
    links them. Of rows that repeat an id those stay whose text is like no other kept one. Columns
    of any name are kept; an empty table gives no rows.
    """
    return ngram_join.keep_one(docs, words=5, percent=75)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 200 bytes that start at several places.

    n_chars becomes the length of what is left. No document goes; a text may end up empty. Null
    texts are empty; an empty table gives no rows. Columns of any name are kept, but for those of
    the operator's report (n_bytes, n_removed, n_spans, kept_sha256), which come back as they were.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("row") if others else F.lit(None).alias("row"))
    left = suffix_dedup.remove_repeats(rows, size=200)
    kept = {name: F.col("row").getField(name) for name in others} | {n: F.col(n) for n in ("doc_id", "text")}
    if "n_chars" in others:
        kept["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(*[kept[name].alias(name) for name in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts, placed in sequences of 1024 tokens.

    Null texts are empty, and an empty text is its end id alone; an empty table gives no rows.
    Other columns take no part.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, path, end_id=2, size=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # trained trees, byte strings and tokens have no SQL: tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
