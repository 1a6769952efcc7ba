"""The registered queries of the corpus operators, with production parameters, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.llm import (bpe, dual_tree, line_dedup, mixing, ngram_join, quality_classifier, quality_rules, sharding, suffix_dedup, toxicity, vector_codes,
                          vptree, warc)
from leadtime.llm.common import cut_lineage, read, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return wrap


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(read(spark, sf_dir, "documents"), width=4, percent=85)


@query("op2_bpe_encode_decode")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read(spark, sf_dir, "documents"), tokenizer(), ids=False)


@query("op3_suffix_array_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_passages(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("first").alias("first_word"), F.col("end").alias("end_word"), "copies")


@query("op4_nearest_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"), every=20, k=20, factor=4.0)


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"))


@query("op7_virtual_slot_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"))
    docs = cut_lineage(docs.withColumn("virtual_slot", sharding.virtual_slot(F.col("doc_id"))), "shard-sizes")
    folder = scratch_path(spark, "slot-map")
    sharding.save_map(sharding.first_map(sharding.slot_bytes(docs), 40), folder)
    placed = sharding.assign(docs, sharding.load_map(spark, folder))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@query("op8_warc_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = warc.write(read(spark, sf_dir, "pages"), folder)
    return warc.read_back(spark, folder, manifest).drop("url")


OP9 = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
l AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w AS ratio,
             (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(max(CASE WHEN level <= ratio THEN level END) OVER () * w, cap)) AS target FROM l),
f AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
c AS (SELECT d.*, f.source_size, f.target, f.passes, f.target - f.passes * f.source_size AS budget,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through,
             sum(size) OVER (PARTITION BY d.source, h) AS here
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
e AS (SELECT *, min(CASE WHEN through > budget THEN h END) OVER (PARTITION BY source) AS edge FROM c),
k AS (SELECT *, max(CASE WHEN h = edge AND (budget - (through - here)) * 2 >= here THEN 1 ELSE 0 END) OVER (PARTITION BY source) AS more FROM e)
SELECT doc_id, size, source_size, target,
       size * (passes + CASE WHEN passes < 3 AND h < edge + more THEN 1 ELSE 0 END) AS taken
FROM k"""


@query("op9_mixing", OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean(read(spark, sf_dir, "documents"), counts=True)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("text_sha256"))


def _op11_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds written out one after another, each part compared with all entries."""
    steps = [f"""
k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
     WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS x FROM k, range({parts}) AS r(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x FROM p QUALIFY e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, label, p.part, any_value(p.x) AS x,
     min(CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.x) + list_inner_product(c.x, c.x) AS BIGINT) * {entries} + e) AS best
     FROM p JOIN c{r} AS c ON p.part = c.part GROUP BY vec_id, label, p.part)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{r} AS c LEFT JOIN
     (SELECT part, e, list(y ORDER BY i) AS x FROM (SELECT part, best % {entries} AS e, i, floor(sum(x[i]) / count(*)) AS y
      FROM a{r}, range(1, len(x) + 1) AS s(i) GROUP BY part, best % {entries}, i) GROUP BY part, e) AS m ON c.part = m.part AND c.e = m.e)""")
    return "WITH" + ",".join(steps) + f""",
s AS (SELECT sha256(string_agg(CAST(x[i] AS BIGINT), ',' ORDER BY part, e, i)) AS codebooks_sha256 FROM c{rounds}, range(1, len(x) + 1) AS s(i)),
f AS (SELECT vec_id, label, string_agg(format('{{:02x}}', best % {entries}), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
      FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f, s"""


@query("op11_vector_codes", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


OP12 = r"""
WITH lowered AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM lowered WHERE len(t) > 0),
s AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM d),
q AS (SELECT i, item_id, t, count(*) AS times FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
      GROUP BY i, item_id, t),
v AS (SELECT DISTINCT t FROM q),
p AS MATERIALIZED (SELECT r, x.t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM d) AS x SEMI JOIN v ON x.t = v.t GROUP BY r, x.t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t, big_n),
g AS (SELECT p.r, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // l))) AS gain FROM p JOIN w ON p.t = w.t JOIN d ON p.r = d.r, s),
f AS (SELECT i, item_id, d.doc_id, d.r, CAST(sum(times * gain) AS BIGINT) AS score FROM g JOIN q ON g.t = q.t JOIN d ON g.r = d.r GROUP BY i, item_id, d.doc_id, d.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM f WHERE score > 0 QUALIFY rank <= 20"""


@query("op12_ranked_lexical_search", OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.top_documents(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"))


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
