"""Rules and phrases by q-grams against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from deskmill.operators import grams, joins
from deskmill.operators.filters import fulltext_phrases

MAIL = "message_id long, mailbox string, sender string, recipients string, subject string, text string, has_attachment boolean, is_chat boolean, size long"
RULE = (
    "mailbox string, rule_id string, `from` string, `to` string, subject string, query string, negated_query string, has_attachment boolean, "
    "exclude_chats boolean, size long, size_comparison string, add_labels array<string>, remove_labels array<string>, forward string"
)


@pytest.fixture(scope="module")
def mail():
    rng = random.Random(4)
    words = ["Invoice", "meeting", "été", "Report", "lunch", "\U0001f600 hi", "a", "x.y", "50%", "%_"]

    def text(n):
        return rng.choice([None, "", " ".join(rng.choice(words) for _ in range(rng.randrange(n)))])

    # One mailbox has most of the mail.
    messages = [
        (i, rng.choice(["hot", "hot", "hot", "b", "c", None]), f"{rng.choice('abc')}@Ex.com", text(3), text(4), text(12), rng.choice([True, False, None]), rng.choice([True, False]), rng.choice([None, 0, 5, 400, 70_000, 1 << 40]))
        for i in range(240)
    ]
    rules = []
    for i in range(90):
        asked = [rng.choice([None, None, None, "", w]) for w in (rng.choice(["a@", "EX.", "b@ex.com"]), *rng.choices(words, k=4))]
        rules.append((
            rng.choice(["hot", "hot", "b", "zz", None]), f"r{i % 80}", *asked, rng.choice([None, False, True]), rng.choice([None, True]),
            rng.choice([None, None, 0, 5, 399, 1 << 33, -1]), rng.choice([None, "larger", "smaller", "Smaller"]), ["x"], None, None,
        ))
    return messages, rules


def holds(m, r):
    _, _, sender, to, subject, text, attached, chat, size = m
    _, _, w_from, w_to, w_subject, query, negated, w_attached, no_chats, w_size, comparison, *_ = r
    has = lambda t, w: w.lower() in (t or "").lower()
    return (
        (not w_from or has(sender, w_from))
        and (not w_to or has(to, w_to))
        and (not w_subject or has(subject, w_subject))
        and (not query or has(subject, query) or has(text, query))
        and (not negated or not (has(subject, negated) or has(text, negated)))
        and (not w_attached or attached)
        and (not no_chats or not chat)
        and (w_size is None or (size is not None and (size < w_size if (comparison or "").lower() == "smaller" else size > w_size)))
    )


def test_rule_table_is_that_of_all_pairs(spark, mail):
    messages, rules = mail
    got = joins.apply_rule_table(spark.createDataFrame(messages, MAIL), spark.createDataFrame(rules, RULE))
    want = sorted((m[0], r[1]) for m in messages for r in rules if m[1] is not None and m[1] == r[0] and holds(m, r))
    assert len(want) > 300
    assert sorted((r.message_id, r.rule_id) for r in got.collect()) == want
    assert joins.apply_rule_table(spark.createDataFrame([], MAIL), spark.createDataFrame(rules, RULE)).count() == 0
    assert joins.apply_rule_table(spark.createDataFrame(messages, MAIL), spark.createDataFrame([], RULE)).count() == 0


def test_a_hot_mailbox_does_not_meet_all_its_rules(spark, monkeypatch):
    mail = spark.range(3000).selectExpr("id AS message_id", "'hot' AS mailbox", "concat('s', id % 700, 'q@x') AS sender", "'r' AS recipients", "concat('subject ', id) AS subject", "'text' AS text", "false AS has_attachment", "false AS is_chat", "id AS size")
    none = lambda kind, *names: [f"CAST(NULL AS {kind}) AS `{n}`" for n in names]
    rules = spark.range(700).selectExpr(
        "'hot' AS mailbox", "concat('r', id) AS rule_id", "IF(id % 2 = 0, concat('s', id, 'q@x'), NULL) AS `from`", *none("STRING", "to", "subject", "query", "negated_query"), "false AS has_attachment", "false AS exclude_chats",
        "IF(id % 2 = 1, 2900 + id % 100, NULL) AS size", "'larger' AS size_comparison", "array('x') AS add_labels", *none("ARRAY<STRING>", "remove_labels"), *none("STRING", "forward"),
    )
    met = []
    real = grams.candidates
    monkeypatch.setattr(grams, "candidates", lambda *a: met.append(real(*a)) or met[-1])
    found = joins.apply_rule_table(mail, rules)
    n = found.count()
    by_sender = sum(1 for i in range(3000) if i % 700 % 2 == 0)
    by_size = sum(99 - k for i in range(1, 700, 2) for k in [i % 100])
    assert n == by_sender + by_size
    # Sizes meet their rules only; senders share grams with few others.
    assert met[0].count() < 0.05 * 3000 * 700


def test_phrases_are_those_of_all_pairs(spark, mail):
    messages, _ = mail
    phrases = ["Meeting", "été", "a", "x.", "50%", "%_", "\U0001f600", "invoice report", "nowhere at all", "", None, "EX.com"]
    df = spark.createDataFrame(messages, MAIL).selectExpr("*", "1 AS token", "2 AS n")
    table = spark.createDataFrame(list(enumerate(phrases)), "phrase_id long, phrase string")
    got = fulltext_phrases(df, ["sender", "subject", "text"], table, "message_id")
    want = sorted((m[0], i) for m in messages for i, p in enumerate(phrases) if p and any(p.lower() in (t or "").lower() for t in (m[2], m[4], m[5])))
    assert sorted((r.message_id, r.phrase_id) for r in got.select("message_id", "phrase_id").collect()) == want
    assert got.columns == [*df.columns, "phrase_id", "phrase"]
    assert fulltext_phrases(df, ["text"], table.limit(0), "message_id").count() == 0


def test_every_text_with_a_needle_has_its_tokens(spark):
    rows = spark.createDataFrame([("Ab cd", "b c"), ("ab", "ab"), ("x", "x"), ("a\nb\U0001f600c", "\nb\U0001f600"), ("aaaa", "aaa")], "t string, w string")
    tokens = rows.select("w", grams.needle_tokens("f", F.col("w")).alias("tokens"))
    posts = grams.text_posts(rows, ["w"], "f", F.col("t"), F.lit(True)).distinct()
    missing = tokens.select("w", F.explode("tokens").alias("token")).join(posts, ["w", "token"], "left_anti")
    assert missing.count() == 0 and tokens.filter("size(tokens) = 0").count() == 0


def test_a_post_is_hashed_once_and_texts_meet_phrases_last(spark, mail):
    df = spark.createDataFrame(mail[0], MAIL)
    tokens = spark.createDataFrame([("|abc",)], "token string")
    posts = grams.text_posts(df, ["message_id"], "", F.col("text"), F.lit(True))
    plan = grams._in_use(posts, tokens, [])._jdf.queryExecution().executedPlan().toString().splitlines()
    assert [line.count("xxhash64") for line in plan if "Filter" in line and "xxhash64" in line] == [1]
    found = fulltext_phrases(df, ["sender", "text"], spark.createDataFrame([(1, "a")], "phrase_id long, phrase string"), "message_id")
    # Each text is folded below the join with what is asked, not once per pair.
    joins_ = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins_ and not any("lower(" in line for line in joins_)
