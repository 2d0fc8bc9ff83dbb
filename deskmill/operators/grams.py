"""Containment joins by an inverted index of character q-grams.

Something that is looked for in texts is filed under one token only, the rarest of its q-grams; a text is filed under those of its q-grams
that are such tokens. What meets at a token is a candidate, which the caller confirms on the whole text. Texts never meet all that is looked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmill.session import durable_cut

# Characters of a token; a shorter needle is a token itself.
Q = 3
# Tokens in use are marked in so many places by their hash, so that a text's other tokens go before the shuffle.
PLACES = 1 << 16


def _grams(text: Column, q: int) -> Column:
    """All runs of ``q`` characters, as they stand in the text; none if it is shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))


def token(field: str | Column, gram: Column) -> Column:
    return F.concat(F.lit(field) if isinstance(field, str) else field, F.lit("|"), gram)


def needle_tokens(field: str, needle: Column) -> Column:
    """The tokens that every text which holds the needle has, too."""
    grams = F.when(F.length(needle) < Q, F.array(needle)).otherwise(F.array_distinct(_grams(needle, Q)))
    return F.transform(grams, lambda g: token(field, g))


def text_posts(texts: DataFrame, keep: Sequence[str], field: str | Column, text: Column, short: Column) -> DataFrame:
    """``keep`` and ``token`` for each token of each text, as often as it stands there; those of fewer than ``Q`` characters only if ``short``."""
    none = F.array().cast("array<string>")
    told = texts.select(*keep, (F.lit(field) if isinstance(field, str) else field).alias("_field"), text.alias("_text"), short.alias("_short"))
    fewer = F.when(F.col("_short"), F.concat(*[_grams(F.col("_text"), q) for q in range(1, Q)])).otherwise(none)
    grams = F.explode(F.concat(_grams(F.col("_text"), Q), fewer))
    return told.select(*keep, "_field", grams.alias("_gram")).select(*keep, token(F.col("_field"), F.col("_gram")).alias("token"))


def _place(on: Sequence[str]) -> Column:
    return F.xxhash64(*on, "token").bitwiseAND(PLACES - 1).cast("int")


def _marked(tokens: DataFrame, on: Sequence[str]) -> Column:
    """For each place whether a token in use lies there: as many marks for any table, found while the query runs."""
    used = tokens.select(_place(on).alias("place")).distinct().withColumn("used", F.lit(True))
    places = tokens.sparkSession.range(0, PLACES, 1, 1).select(F.col("id").cast("int").alias("place"))
    marks = places.join(used, "place", "left").agg(F.sort_array(F.collect_list(F.struct("place", F.coalesce("used", F.lit(False)).alias("used")))).alias("marks"))
    return marks.select("marks.used").scalar()


def _in_use(posts: DataFrame, tokens: DataFrame, on: Sequence[str]) -> DataFrame:
    # The filter names the place once: it would be computed anew each time.
    return posts.filter(F.get(_marked(tokens, on), _place(on)))


def candidates(posts: Callable[[Column], DataFrame], wanted: DataFrame, on: Sequence[str], key: str, wanted_key: str) -> DataFrame:
    """Pairs of ``key`` and ``wanted_key`` (with ``on``) that share the rarest token of what is wanted.

    ``posts(short)`` gives a row (``on``, ``key``, ``token``) per text and token, with short tokens where ``short`` holds; ``wanted`` has ``on``,
    ``wanted_key``, ``tokens`` (a text must have all of them), ``is_short`` and ``part``, which numbers the rows of one key that each find texts
    of their own. Rows without tokens find nothing.
    """
    short = wanted.agg(F.coalesce(F.bool_or("is_short"), F.lit(False))).scalar()
    asked = wanted.select(*on, wanted_key, "part", F.explode("tokens").alias("token"))
    seen = _in_use(posts(short), asked, on).groupBy(*on, "token").agg(F.count("*").alias("n"))
    counted = asked.join(seen, [*on, "token"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = counted.groupBy(*on, wanted_key, "part").agg(F.min(F.struct("n", "token")).alias("rarest")).select(*on, wanted_key, "rarest.*")
    # A token that no text has ends the search for what is filed there.
    chosen = durable_cut(rarest.filter("n > 0").select(*on, wanted_key, "token"))
    return _in_use(posts(short), chosen, on).join(chosen, [*on, "token"]).select(*on, key, wanted_key).distinct()
