"""The registered queries of the pipeline's operators, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import deskmill
from deskmill.llm import bpe, fill_in_middle, importance, langid, minhash, mixing, pii, quality, simhash, substring_dedup, suffix_dedup, topk, warc
from deskmill.llm.common import table, word_count
from deskmill.session import configure

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


# What a Python worker is given at a time, rows and bytes; texts vary in length, so both are bounded.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def ready(spark: SparkSession) -> SparkSession:
    """Set the session up, and let Python workers import this library from where the driver has it."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if (root := str(Path(deskmill.__file__).resolve().parent.parent)) not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return configure(spark)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted on rows that are not held out; the key decides about that and is not seen by the model."""
    known = docs.filter(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang")
    return langid.train(known, langid.vocabulary(public_tokenizers.path(PIECES)))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return bpe.encode(docs, "doc_id", "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN, columns=("ids_sha256", "decoded_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(ready(spark), sf_dir, "pages"), warc.archive_dir(spark))
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return langid.with_language(docs.select("doc_id", "text"), language_model(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(ready(spark), sf_dir, "documents").select("doc_id", "text"), counts="replaced")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(ready(spark), sf_dir, "labels")
    return quality.rate(table(spark, sf_dir, "documents"), labels.filter("quality = 1"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(ready(spark), sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated_words(table(ready(spark), sf_dir, "documents"), digests=True).withColumnRenamed("kept", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(ready(spark), sf_dir, "documents").select("doc_id", "text", "source"), "doc_id", word_count(F.col("text")), "source")
    taken = (F.col("mix_size") * F.col("mix_times")).alias("taken")
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), taken)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(ready(spark), sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(ready(spark), sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(ready(spark), sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(ready(spark), sf_dir, "documents"))
    digests = {f"{name}_sha256": F.sha2(text.cast("binary"), 256) for name, text in (("output", F.col("output")), ("restored", fill_in_middle.restored(F.col("output"), F.col("form"))))}
    return cut.withColumns(digests).drop("output")


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(ready(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


_QUERIES = (op1_byte_bpe, op2_warc, op3_language_id, op4_pii, op5_quality, op6_suffix_dedup, op7_substring_dedup, op8_mixing, op9_topk, op10_simhash, op11_importance_resampling, op12_fill_in_middle, op13_minhash)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# A window of the whole table per key instead of the operators' passes.
_SQL = {
    "op2_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS m FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m <> page_id THEN m END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM f""",
    "op7_substring_dedup": rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w),
k AS (SELECT doc_id, i, list_slice(words, i, i + 12) AS win FROM s),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM k) WHERE least < doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM g),
l AS (SELECT doc_id, list(place) AS gone FROM x GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_transform(list_filter(range(1, len(words) + 1), lambda p: NOT list_contains(gone, p)), lambda p: words[p]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN l USING (doc_id)""",
    "op8_mixing": rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS hash FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * source_size AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
r AS (SELECT arg_min(level, most / weight) AS level FROM l WHERE level <= most / weight),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE least(most, r.level * weight) END::DOUBLE AS target FROM l, r),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS times FROM t),
c AS (SELECT d.*, b.source_size, b.target, b.times, sum(d.size) OVER (PARTITION BY d.source ORDER BY hash RANGE UNBOUNDED PRECEDING) <= target - times * b.source_size AS more
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CAST(size * least(times + CAST(more AS INTEGER), 3) AS BIGINT) AS taken FROM c""",
    "op9_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_fill_in_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (SELECT *, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS b,
             CAST('0x' || substr(d, 17, 8) AS BIGINT) % 100 AS x, CAST('0x' || substr(d, 25, 8) AS BIGINT) % 100 AS y FROM h),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x >= 90 THEN 'plain' WHEN y < 20 THEN 'spm' ELSE 'psm' END AS form,
             least(a, b) AS p, greatest(a, b) AS q FROM u),
o AS (SELECT *, substring(t, 1, p) AS pre, substring(t, p + 1, q - p) AS mid, substring(t, q + 1, n - q) AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(q - p AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o""",
    "op13_minhash": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS shingle
      FROM d WHERE len(w) > 0),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, md5(string_agg(shingle, chr(10) ORDER BY shingle)) AS name FROM s GROUP BY doc_id),
g AS (SELECT name, min(doc_id) AS node FROM k GROUP BY name),
m AS (SELECT doc_id, node FROM k JOIN g USING (name)),
p AS (SELECT s.doc_id, shingle FROM s JOIN g ON g.node = s.doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM p a JOIN p b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM i JOIN c cx ON cx.doc_id = x JOIN c cy ON cy.doc_id = y WHERE 100 * i.n >= 85 * (cx.n + cy.n - i.n)),
l AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT node AS x, node AS y FROM g UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
t AS (SELECT x AS node, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, coalesce(t.component_id, d.doc_id) AS component_id, coalesce(t.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id LEFT JOIN t ON t.node = m.node""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
