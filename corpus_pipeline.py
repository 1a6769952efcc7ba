"""The corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, encoding."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from leadtime.llm.catalog import tokenizer
from leadtime.llm.common import MADE, cut_lineage, discard, read, settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: When the former stage returned, and its scratch tables.
_former: tuple[float, list[str]] = (0.0, [])


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]):
    """A stage that first deletes the former stage's scratch tables, if its own rows were written after that stage returned, and
    lets the driver drop what it holds of the former stage's queries.

    Such rows are the former stage's stored result, which needs them no more. Rows of any other kind leave them alone.
    """
    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        global _former
        returned, paths = _former
        if paths and (files := docs.inputFiles()):
            place = spark._jvm.org.apache.hadoop.fs.Path(files[0])
            status = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place)
            if status.getModificationTime() / 1000 > returned:
                for path in paths:
                    discard(spark, path)
        settle(spark)
        begun = len(MADE)
        out = work(spark, docs, sf_dir)
        _former = time.time(), MADE[begun:]
        return out

    return run_stage


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose posterior quality is 0.5 or more; rows are judged one by one."""
    return quality_rules.judge(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


@stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that another line of the corpus stands for; n_chars follows the new text."""
    return line_dedup.clean(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of five-word shingle sets with a similarity of 0.8 or more: the one with the smallest doc_id.

    A row is its doc_id and text: rows that share a doc_id but not the text are judged apart, rows that share both are one. A
    NULL doc_id is larger than any other, equal ids go by a hash of the text. Documents without words stay.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"))
    rows = docs.select(*COLUMNS, row.alias("_row"))
    found = ngram_join.jaccard_components(rows.select("_row", "text"), key="_row", width=5, percent=80)
    kept = found.where(F.col("component_id") == F.col("_row")).groupBy("_row").agg(F.count("*").alias("_same")).withColumnRenamed("_row", "_kept")
    first = rows.join(kept, F.col("_row") == F.col("_kept"))
    # only rows that are there several times are compared with one another; the other texts are not shuffled again
    return first.where("_same = 1").select(*COLUMNS).unionByName(first.where("_same > 1").dropDuplicates(["_row"]).select(*COLUMNS))


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    passes = mixing.mix(docs).select(F.col("doc_id").alias("_id"), "passes").groupBy("_id").agg(F.max("passes").alias("passes"))
    return (docs.join(passes, F.col("doc_id").eqNullSafe(F.col("_id"))).where("passes > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes")))).select(*COLUMNS))


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids_sha256, decoded_sha256) of every document of the mix."""
    coded = bpe.encode(docs.select(F.struct("doc_id", "source").alias("row"), "text"), tokenizer(), key="row", ids=False)
    return coded.select("row.doc_id", "row.source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix), ("BPE encoding", encode)]

#: The posterior of the rules, SimHash and byte-pair merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are stored before the next one reads them."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, "stage-" + name.replace(" ", "-").lower())
    return docs
