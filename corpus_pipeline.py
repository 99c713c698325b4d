"""The training-data pipeline: stages over `documents`, each one of the
operators in clickguard.llm, written as a table and read as the next one's
input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickguard.llm import decontaminate, pieces, quality, simhash, substring
from clickguard.llm.common import fresh, read_table, stored
from clickguard.llm.queries import MODEL


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a hash of id and text, and the name of that column: rows that
    repeat both share it, all others, also those without an id, have their own.
    Decisions are joined by id and hash, so rows of different ids never mix."""
    row = fresh("pipeline_row", docs.columns)
    return docs.withColumn(row, F.xxhash64("doc_id", "text")), row


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier predicts good stay; null and empty texts are
    scored like any other."""
    docs, row = keyed(docs)
    scores = quality.quality_scores(docs, read_table(spark, sf_dir, "labels"), row_col=row)
    good = scores.where("predicted = 1").select(F.col("doc_id").alias("good_id"),
                                                F.col(row).alias("good_row")).distinct()
    same = (docs[row] == good.good_row) & docs.doc_id.eqNullSafe(good.good_id)
    return docs.join(good, same, "left_semi").drop(row)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component stays: of those with its smallest id,
    the one with the smallest key. Rows without an id come last, so one of them
    stays only where no member of its component has one. Of rows that repeat
    both id and text one stays. Null and empty texts are one group."""
    docs, row = keyed(docs)
    found = simhash.simhash_components(docs.select(F.col(row).alias("row"), "text"), "row")
    found = found.groupBy("row", "component_id").agg(F.count("*").alias("rows"))
    ids = docs.select(F.col(row).alias("row"), "doc_id").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "rows")
    keep = stored(found.join(ids, "row").groupBy("component_id").agg(F.min(place).alias("first"))
                  .select("first.*"), "pipeline-groups")
    once, more = (keep.where(c).select(F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
                  for c in ("rows = 1", "rows > 1"))
    same = (docs[row] == F.col("keep_row")) & docs.doc_id.eqNullSafe(F.col("keep_id"))
    return (docs.join(once, same, "left_semi")
            .unionByName(docs.join(more, same, "left_semi").dropDuplicates(["doc_id", "text"]))
            .drop(row))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier row keeps are cut: one with a smaller id, or of
    rows that share it a smaller hash of the text; rows without an id come last.
    Rows that lose their whole text go, null and empty texts stay."""
    cut = substring.cut_later_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go; null and empty texts stay."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with whether they decode to the text; null
    texts have null ones."""
    return pieces.encode(docs, MODEL, check=True)


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("substring", substring_stage),
    ("decontaminate", decontaminate_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Not expressible in SQL (hash functions, trained models, tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
