"""License scan: exact set-similarity join of text blocks with license templates, and phrase places.

A template is a short notice with a label; its tokens are its distinct words, and some of them, which name the
license, may be required. A text block is a window of consecutive words, across line breaks, of a length set by
the template: ``ceil(words / threshold)``, so that a notice may be wrapped and hold some words more. A block meets a
template if it holds at least ``threshold`` of the template's tokens (containment) and all required ones. The join
is exact and filtered in steps, after the tokens of all templates were ordered by their document frequency over the
*whole* corpus, rarest first:

* prefix: a block that meets a template with ``n`` tokens needs ``a = ceil(threshold * n)`` of them, so it holds one
  of the template's first ``n - a + 1``; only places of such words are joined, each with the words around it;
* length: words around that hold fewer than ``a`` of the template's tokens have no block that meets it;
* position: a shared token at place ``i`` of the template and ``j`` of the block's ordered template tokens leaves at
  most ``1 + min(n - i, len - j)`` (places from 1) shared tokens in all.

What passes is verified by the intersection. Blocks start at a token of their template (a block that doesn't is met
by a later one that does). Texts are cut into overlapping pieces of ``PIECE`` words first, so that what one row holds
doesn't depend on the text's length; no window is lost. The templates are a parameter of the program, so their
postings are small by construction and broadcast; the corpus is only scanned, never shuffled whole.

Beside the join, ``phrases`` are counted wherever their words stand consecutively (also across lines).

Defined results: null or empty text has no words, no places, empty labels and score 0; repeated rows
(same id and text) get the same result each; rows with a null id are kept. Only the named columns of
the input are used, so further columns can't clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import text_of, words

#: Phrases with their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Notices that stand for a license, as commonly written, and the words that a block can't lack.
TEMPLATES = [
    ("mit", "Released under the MIT License.", ["mit"]),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files, to deal in the Software without restriction", []),
    ("apache", "Licensed under the Apache License, Version 2.0.", ["apache"]),
    ("gpl", "This work is licensed under the GNU General Public License, version 3.", ["general", "public"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0.", ["cc", "nc"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", []),
]
THRESHOLD = 0.8
#: Words of a text that one row holds, beside the longest block.
PIECE = 1_024

Template = tuple[str, str, Sequence[str]]


def _word_list(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def template_tokens(text: str) -> list[str]:
    return sorted(set(_word_list(text)))


def block_words(text: str, threshold: float) -> int:
    """Length in words of the blocks that a template is compared with."""
    return math.ceil(len(_word_list(text)) / threshold - 1e-9)


def _needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def frequency_order(docs: DataFrame, vocabulary: Sequence[str], text: str = "text") -> list[str]:
    """``vocabulary`` by document frequency over all documents, rarest first (ties by word)."""
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    counted = (docs.select(F.explode(F.array_intersect(vocab, words(F.col(text)))).alias("w"))
               .groupBy("w").count().collect())  # at most one row a template token
    seen = {r["w"]: r["count"] for r in counted}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def phrase_starts(tokens: Column, phrase: str) -> Column:
    """Places (from 0) in ``tokens`` where the words of ``phrase`` stand consecutively."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        out = F.get(tokens, i) == parts[0]
        for k, word in enumerate(parts[1:], 1):
            out = out & (F.get(tokens, i + k) == word)
        return out

    places = F.filter(F.sequence(F.lit(0), F.size(tokens) - len(parts)), here)
    may_hold = (F.size(tokens) >= len(parts)) & F.array_contains(tokens, parts[-1])
    return F.when(may_hold, places).otherwise(F.array().cast("array<int>"))


def template_matches(docs: DataFrame, templates: Sequence[Template], threshold: float, *, key: str = "doc_id",
                     text: str = "text", piece: int = PIECE) -> DataFrame:
    """(key, h, start, label, containment): every block that meets a template; ``h`` is a hash of the text.

    ``start`` is the number of the block's first word in the text, from 0. A block near the end of a piece may come
    twice, shortened at first.
    """
    listed = [(label, template_tokens(t), list(named), block_words(t, threshold)) for label, t, named in templates if template_tokens(t)]
    order = frequency_order(docs, sorted({w for _, ws, _, _ in listed for w in ws}), text)
    rank = {w: i for i, w in enumerate(order)}
    longest = max(size for *_, size in listed)
    postings, prefixes = [], set()
    for label, ws, named, size in listed:
        ws = sorted(ws, key=rank.__getitem__)
        need = _needed(len(ws), threshold)
        for i, w in enumerate(ws[: len(ws) - need + 1], 1):
            postings.append((w, label, i, len(ws), need, size, ws, named))
            prefixes.add(w)
    spark = docs.sparkSession
    index = spark.createDataFrame(
        postings, "w string, label string, i int, n int, need int, size int, ws array<string>, named array<string>")
    vocab = F.array(*[F.lit(w) for w in order])
    prefix = F.array(*[F.lit(w) for w in sorted(prefixes)])

    def around(i: Column) -> Column:
        first = F.greatest(i - (longest - 1), F.lit(0))
        return F.struct(F.get("_piece", i).alias("w"), first.alias("first"), (i - first).alias("at"),
                        F.slice("_piece", first + 1, 2 * longest - 1).alias("near"))

    def block(s: Column) -> Column:
        return F.struct(s.alias("s"), F.array_intersect(vocab, F.slice("near", s + 1, F.col("size"))).alias("held"))

    pieces = (
        docs.select(F.col(key).alias("_key"), text_of(F.col(text)).alias("_text"))
        .select("_key", F.xxhash64("_text").alias("h"), words(F.col("_text")).alias("_w"))
        .where(F.arrays_overlap("_w", prefix))
        .select("_key", "h", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("_w") - 1, F.lit(piece)),
                                                      lambda s: F.slice("_w", s + 1, piece + longest - 1))).alias("_no", "_piece")))
    places = pieces.select("_key", "h", "_no", F.inline(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_piece") - 1), lambda i: F.array_contains(prefix, F.get("_piece", i))), around)))
    near = places.join(F.broadcast(index), "w").where(F.size(F.array_intersect("near", "ws")) >= F.col("need"))
    starts = F.filter(F.sequence(F.greatest(F.col("at") - F.col("size") + 1, F.lit(0)), F.col("at")),
                      lambda s: F.array_contains(F.col("ws"), F.get("near", s)))
    blocks = near.select("_key", "h", "_no", "first", "w", "label", "i", "n", "need", "ws", "named",
                         F.inline(F.transform(starts, block)))
    j = F.array_position("held", F.col("w"))
    close = blocks.where((F.size("held") >= F.col("need"))
                         & (1 + F.least(F.col("n") - F.col("i"), F.size("held") - j) >= F.col("need")))
    share = F.size(F.array_intersect("held", "ws"))
    return close.where((share >= F.col("need")) & (F.size(F.array_intersect("named", "held")) == F.size("named"))).select(
        F.col("_key").alias(key), "h", (F.col("_no") * piece + F.col("first") + F.col("s")).cast("long").alias("start"),
        "label", (share / F.col("n")).alias("containment"))


def scan_licenses(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                  phrases: Sequence[tuple[str, str]] = PHRASES,
                  templates: Sequence[Template] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    ``score`` is 1 if a phrase occurs, else the highest containment of a template met by a block, else 0.
    """
    found = template_matches(docs, templates, threshold, key=key, text=text).groupBy(
        F.col(key).alias("_k"), F.col("h").alias("_h")).agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_best"))
    base = docs.select(F.col(key).alias("_key"), F.xxhash64(text_of(F.col(text))).alias("h"),
                       words(F.col(text)).alias("_w"))
    base = base.select("_key", "h", F.size("_w").cast("long").alias("n_words"),
                       *[phrase_starts(F.col("_w"), p).alias(f"_s{i}") for i, (p, _) in enumerate(phrases)])
    places = F.concat(*[F.col(f"_s{i}") for i in range(len(phrases))])
    labels = F.array_distinct(F.filter(F.array(*[F.when(F.size(f"_s{i}") > 0, F.lit(label))
                                                 for i, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull()))
    base = base.select("_key", "h", "n_words", places.alias("_places"), labels.alias("_base"))
    joined = base.join(found, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("h") == F.col("_h")), "left")
    n_base = F.size("_places").cast("long")
    every = F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    return joined.select(
        F.col("_key").alias(key), "n_words", n_base.alias("n_base"),
        F.array_min("_places").cast("long").alias("first_word"), F.array_max("_places").cast("long").alias("last_word"),
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def op6_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    table = ", ".join(
        f"({t}, '{label}', '{w}', {len(ws)}, {_needed(len(ws), THRESHOLD)}, {block_words(text, THRESHOLD)}, {w in named}, {len(named)})"
        for t, (label, text, named) in enumerate(TEMPLATES) for ws in [template_tokens(text)] for w in ws)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words_of = lambda c: f"regexp_extract_all(translate({c}, '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    places = [
        "list_filter(range(0, len(w)), lambda i: " + " AND ".join(
            f"w[i + {k + 1}] IS NOT DISTINCT FROM '{x}'" for k, x in enumerate(p.split(" "))) + ")" for p, _ in PHRASES]
    return f"""
WITH token(t, label, x, n, need, size, named, n_named) AS (VALUES {table}),
tok AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words_of("coalesce(text, '')")} AS w FROM documents),
hit AS (SELECT r, p, token.* FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM tok) JOIN token USING (x)),
block AS (SELECT r, label, n, need, n_named, count(DISTINCT x) OVER b AS c, count(DISTINCT CASE WHEN named THEN x END) OVER b AS c_named
          FROM hit WINDOW b AS (PARTITION BY r, t ORDER BY p RANGE BETWEEN CURRENT ROW AND size - 1 FOLLOWING)),
best AS (SELECT r, list(DISTINCT label) AS labels, max(c / n) AS c FROM block WHERE c >= need AND c_named = n_named GROUP BY r),
st AS (SELECT r, doc_id, len(w) AS n_words, {", ".join(f"{p} AS s{i}" for i, p in enumerate(places))} FROM tok),
al AS (SELECT r, doc_id, n_words, list_concat(list_concat(s0, s1), s2) AS p,
         list_filter([{", ".join(f"CASE WHEN len(s{i}) > 0 THEN '{x}' END" for i, (_, x) in enumerate(PHRASES))}],
                     lambda x: x IS NOT NULL) AS bl FROM st)
SELECT doc_id, n_words::BIGINT AS n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word,
  list_max(p)::BIGINT AS last_word, coalesce(array_to_string(list_sort(bl), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(bl, coalesce(labels, [])))), ','), '') AS labels,
  CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM al LEFT JOIN best USING (r)
"""


SQL = _sql()
