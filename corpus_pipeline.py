"""The corpus pipeline: documents through five of the operators, each stage written and read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.bbit_minhash import near_duplicates
from siltstone.llm.frames import table
from siltstone.llm.line_runs import WORD, drop_repeated_lines
from siltstone.llm.mixing import mix_sources
from siltstone.llm.packing import pack
from siltstone.llm.repetition import good_documents
from siltstone.session import stored, tune


OTHERS = "other_columns"


def _apart(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all others packed into one, so that no name can clash with one that an operator uses."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, F.struct(*(others or [F.lit(0)])).alias(OTHERS))


def _whole(rows: DataFrame, columns: list[str], needed: Sequence[str], **changed: Column) -> DataFrame:
    """The columns in their old order, some of them changed."""
    held = {c: F.col(c) if c in needed else F.col(OTHERS).getField(c) for c in columns}
    return rows.select(*[changed.get(c, held[c]).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go. Rows are judged one by one, repeated ones alike; all columns come back
    as they are, whatever their names. An empty table stays empty.
    """
    tune(spark)
    return good_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents that consist of nothing else.

    ``n_chars`` follows a text that changed. Null texts and texts without words stay as they are; rows equal in id
    and text are treated alike. All other columns come back as they are. An empty table stays empty.
    """
    tune(spark)
    needed = ("doc_id", "text")
    cut = drop_repeated_lines(_apart(docs, *needed))
    changed = F.col("removed_lines") > 0
    left = cut.where(~changed | F.col("text").rlike(WORD))
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col(OTHERS).getField("n_chars"))
    return _whole(left, docs.columns, needed, n_chars=n_chars)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id.

    Documents without words are in no group and stay, and so do rows without an id; rows of an id that stays are all kept.
    All columns come back as they are. An empty table stays empty.
    """
    tune(spark)
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    marked = docs.select("doc_id", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = marked.join(kept, marked["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    return left.select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source gets the same share of the text, which stays as much as it is.

    A null source is a source; sources without text go. Repeated rows are repeated alike. All columns come back as they
    are, a column ``copy`` of the documents as well. An empty table stays empty.
    """
    tune(spark)
    needed = ("doc_id", "source", "text")
    return _whole(mix_sources(_apart(docs, *needed)), docs.columns, needed)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences; a repeated document is packed as often as it is there.

    Null and empty texts are the end id alone. Other columns are not read. An empty table gives no pieces.
    """
    tune(spark)
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing to target weights", mixing),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
