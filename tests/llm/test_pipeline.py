"""The stages of the corpus pipeline against what their operators say, and odd rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from deskmill.llm import langid, minhash, queries
from deskmill.llm.common import table
from tests.llm.test_minhash import brute_force, edited
from tests.oracle import connect, difference

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    queries.ready(spark)
    return table(spark, SMALL, "documents")


def test_every_operator_has_one_query():
    names = queries.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert set(names) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_registered_queries_agree_with_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name) is None


def test_rejected_languages_go(spark, docs):
    odd = docs.limit(0).unionByName(spark.createDataFrame([(-1, "12 34", "en", "s", 5), (-2, None, "en", "s", 0)], docs.schema))
    kept = STAGES["language_id"](spark, docs.unionByName(odd), SMALL)
    assert kept.columns == docs.columns and kept.filter("doc_id < 0").count() == 0
    told = langid.with_language(docs, queries.language_model(docs)).filter("lang_pred <> 'und' AND score >= 0.5")
    assert kept.count() == told.count() >= 0.95 * docs.count()


def test_one_of_each_group_stays(spark, docs):
    twice = docs.unionByName(docs.limit(20)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    kept = STAGES["simhash_dedup"](spark, twice, SMALL)
    groups = minhash.near_duplicates(docs, percent=80)
    want = sorted(r.component_id for r in groups.select("component_id").distinct().collect())
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == want
    assert kept.filter("doc_id IS NULL").count() == 1 and kept.columns == docs.columns


def test_the_mix_repeats_rows(spark, docs):
    mixed = STAGES["mixing"](spark, docs, SMALL)
    taken = {r.doc_id: r.taken for r in queries.op8_mixing(spark, SMALL).filter("taken > 0").collect()}
    sizes = {r.doc_id: r.size for r in queries.op8_mixing(spark, SMALL).collect()}
    found = {r.doc_id: r["count"] * sizes[r.doc_id] for r in mixed.groupBy("doc_id").count().collect() if sizes[r.doc_id]}
    assert found == taken and mixed.columns == docs.columns


def test_clashing_columns_stay(spark, docs):
    odd = docs.selectExpr("*", "1L AS mix_times", "source AS mix_source", "'x' AS found_lang", "0 AS mix", "2 AS new_text_0")
    more = docs.selectExpr("*", "doc_id AS kept_id", "xxhash64(text) AS kept_hash", "3 AS kept", "4 AS component", "5 AS text_hash", "map('a', doc_id) AS labels", "6 AS `dotted.name`")
    found = STAGES["simhash_dedup"](spark, more, SMALL)
    assert found.columns == more.columns and found.filter("labels['a'] <> doc_id OR kept_id <> doc_id").count() == 0
    assert found.count() == STAGES["simhash_dedup"](spark, docs, SMALL).count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, odd, SMALL)
        assert found.columns == odd.columns and found.count() > 0, name
        assert found.filter("mix_times <> 1 OR found_lang <> 'x' OR new_text_0 <> 2").count() == 0, name


def test_all_stages(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert rows.count() > 0 and rows.filter("length(ids) <> 4 * n_tokens").count() == 0


def test_an_empty_corpus(spark, docs):
    step = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SMALL)
        assert step.count() == 0


def test_the_stage_drops_near_copies(spark, docs):
    rows = edited(docs) + [(200_000, "  "), (200_001, None), (200_002, "two words"), (200_003, "Two  Words")]
    want, near = brute_force(rows, 80)
    assert near > 20
    shaped = spark.createDataFrame([(key, text, "en", "s", len(text or "")) for key, text in rows], docs.schema)
    kept = STAGES["simhash_dedup"](spark, shaped, SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({least for _, _, least in want})


def test_rows_that_share_an_id_are_told_apart(spark, docs):
    copy, rows = "a b c d e f g h i j", []
    for i in range(0, 40, 2):
        rows += [(i, f"{copy} n{i} m{i} o{i}"), (i + 1, f"{copy} n{i} m{i} o{i}".upper()), (i + 1, " ".join(f"clean{i}x{k}" for k in range(9)))]
    want = {(i, t) for i, t in rows if i % 2 == 0 or t.startswith("clean")}
    shaped = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    kept = STAGES["simhash_dedup"](spark, shaped, SMALL)
    assert {(r.doc_id, r.text) for r in kept.collect()} == want and kept.count() == len(want)
