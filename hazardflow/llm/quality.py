"""Quality classifier: interpolated modified Kneser-Ney byte n-grams, perplexity, language quantiles.

The model is trained on *all* trusted texts (labelled of good quality and not toxic). Its symbols are the
bytes of the raw text, so that no vocabulary has to be cut and upper case, markup and noise count.

1. Counts of the highest order come from one pass over the trusted texts; lower orders hold continuation
   counts (distinct left neighbours), each one aggregation of the order above. Discounts D1, D2, D3+ per
   order come from the counts of counts; a context's left-over mass goes to the next lower order, down to
   the uniform distribution over 256 bytes.
2. Scoring is a sharded count join. Documents are dealt to blocks of about ``BLOCK_BYTES``; each block asks
   once for every distinct n-gram it holds, the questions meet the count tables in a join on the suffixes
   and contexts of all orders, and the answers go back to the blocks, which add up log
   probabilities per document. What is shuffled is the texts once and one row per block and distinct n-gram.
   Models are cross-fitted: texts fall in two folds by their hash, and every text is scored by the model
   of the other fold, so trusted texts are as unseen as all others and their perplexities compare.
3. A document is rejected if its perplexity per byte is above the threshold of its language and length band
   (bands grow by a factor of four): the ``QUANTILE`` of the perplexities of trusted texts there, every different
   text once, counted exactly over bins of 0.1 % width. Short texts scatter widely, so a threshold over all lengths
   would let long junk pass. A band of fewer than ``BAND_TEXTS`` trusted texts takes the language's threshold over all
   lengths; a language without trusted documents takes the quantile over all of them.

Defined results: null and empty texts have no perplexity and are rejected; null languages form a language
of their own; without any trusted text every non-empty text is kept; repeated rows are judged alike; labels
are matched by id (several labels for an id: trusted only if all say so), null ids are never trusted. A task works
on slices of about ``SLICE_BYTES`` of text, or one longer text, with some 60 bytes of arrays a byte of the slice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .batches import slices, text_buffer
from .columns import text_of
from .tables import written

ORDER = 4
QUANTILE = 0.995
BLOCK_BYTES = 16 << 20
BINS = 1000  # a factor of e
#: Trusted texts that a length band of a language needs for a threshold of its own.
BAND_TEXTS = 100
#: Ids that may be broadcast (8 bytes each); beyond, the labels are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Bit of an n-gram's code that tells the two cross-fitted models apart; bytes take the lower 48.
FOLD_BIT = 56
_HELD = 2_000_000  # distinct n-grams that a task gathers before it passes them on


def byte_codes(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(text of each byte, n-gram that ends there): ``order`` bytes, the latest lowest, zero bytes before the start."""
    raw, offsets = text_buffer(texts)
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(raw)) + (order - 1) * (doc + 1)
    padded = np.zeros(len(raw) + (order - 1) * len(sizes), np.uint8)
    padded[at] = raw
    codes = np.zeros(len(raw), np.int64)
    for k in range(order - 1, -1, -1):
        codes = (codes << 8) | padded[at - k]
    return doc, codes


def _added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[at], np.add.reduceat(count, at) if len(at) else count[:0]


def _count_batches(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0

        def out() -> pa.RecordBatch:
            code, count = _added_up(codes, counts)
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "n"])

        for batch in batches:
            texts, folds = batch.column(0), batch.column(1).to_numpy()
            for lo, hi in slices(texts):
                doc, code = byte_codes(texts.slice(lo, hi - lo), order)
                code, count = np.unique(code | (folds[lo:hi].astype(np.int64) << FOLD_BIT)[doc], return_counts=True)
                codes.append(code)
                counts.append(count.astype(np.int64))
                held += len(code)
                if held > _HELD:
                    merged = _added_up(codes, counts)
                    codes, counts, held = [merged[0]], [merged[1]], len(merged[0])
                    if held > _HELD // 2:
                        yield out()
                        codes, counts, held = [], [], 0
        if held:
            yield out()
    return run


def _suffix(k: int) -> Column:
    """The last ``k`` bytes of ``code``, of the same model."""
    return F.col("code").bitwiseAND(F.lit(((1 << 8 * k) - 1) | (1 << FOLD_BIT)))


def fold_of(text_hash: Column) -> Column:
    return F.pmod(F.xxhash64(text_hash, F.lit("fold")), F.lit(2)).cast("int")


def count_grams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(k, code, n) of all orders from the columns ``_text`` and ``_fold`` (of the model): raw counts at ``order``, continuation counts below."""
    ship_package(texts.sparkSession)
    top = texts.select("_text", "_fold").mapInArrow(_count_batches(order), "code long, n long")
    level = written(top.groupBy("code").agg(F.sum("n").alias("n")), "grams")
    out = level.select(F.lit(order).alias("k"), "code", "n")
    for k in range(order - 1, 0, -1):
        level = level.groupBy(_suffix(k).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(level.select(F.lit(k).alias("k"), "code", "n"))
    return written(out, "orders")


def discounts(counts: dict[int, int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams seen once, twice, three and four times."""
    if min(counts.get(i, 0) for i in (1, 2, 3, 4)) == 0:
        return [0.5, 1.0, 1.5]  # too few n-grams for the estimate
    y = counts[1] / (counts[1] + 2 * counts[2])
    return [min(float(i), max(0.0, i - (i + 1) * y * counts[i + 1] / counts[i])) for i in (1, 2, 3)]


def kneser_ney(grams: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """((k, code, share), (k, context, left)): discounted shares of seen n-grams, left-over mass of seen contexts."""
    seen = grams.groupBy("k", F.least(F.col("n"), F.lit(5)).alias("n")).count().collect()  # five rows an order
    discount: Column = F.lit(0.0)
    for k in range(1, order + 1):
        d1, d2, d3 = discounts({r["n"]: r["count"] for r in seen if r["k"] == k})
        of_n = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        discount = F.when(F.col("k") == k, of_n).otherwise(discount)
    rows = grams.select("k", "code", F.shiftright("code", 8).alias("context"), "n", discount.alias("d"))
    contexts = rows.groupBy("k", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("d_sum"))
    shares = rows.join(contexts, ["k", "context"]).select("k", "code", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"))
    left = contexts.select("k", "context", (F.col("d_sum") / F.col("total")).alias("left"))
    return written(shares, "shares"), written(left, "left")


def log_probabilities(asked: DataFrame, shares: DataFrame, left: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, logp) of the distinct n-grams in ``asked`` (code).

    Every n-gram asks for its suffixes (slot 2k) and their contexts (slot 2k + 1) of all orders in one join
    on (slot, key); its answers are put together again by n-gram.
    """
    table = shares.select((F.col("k") * 2).alias("slot"), F.col("code").alias("key"), F.col("share").alias("value")).unionByName(
        left.select((F.col("k") * 2 + 1).alias("slot"), F.col("context").alias("key"), F.col("left").alias("value")))
    slots = [F.struct(F.lit(2 * k + part).alias("slot"), (F.shiftright(_suffix(k), 8) if part else _suffix(k)).alias("key"))
             for k in range(1, order + 1) for part in (0, 1)]
    probes = asked.select("code").distinct().select("code", F.inline(F.array(*slots)))
    found = probes.join(table, ["slot", "key"], "left").groupBy("code").agg(
        *[F.max(F.when(F.col("slot") == s, F.col("value"))).alias(f"v{s}") for s in range(2, 2 * order + 2)])
    p: Column = F.lit(1.0 / 256)
    for k in range(1, order + 1):
        p = F.coalesce(F.col(f"v{2 * k}"), F.lit(0.0)) + F.coalesce(F.col(f"v{2 * k + 1}"), F.lit(1.0)) * p
    return found.select("code", F.log(p).alias("logp"))


def _other_model(block: int) -> int:
    """Code bit of the model that scores a block: blocks hold texts of one fold, odd ones of fold 1."""
    return (1 - block % 2) << FOLD_BIT


def _ask(order: int):
    def run(group: pa.Table) -> pa.Table:
        texts, block = group.column("_text").combine_chunks(), group.column("_block")[0].as_py()
        found = [np.unique(byte_codes(texts.slice(lo, hi - lo), order)[1]) for lo, hi in slices(texts)]
        code = np.unique(np.concatenate(found)) | _other_model(block)
        return pa.table({"_block": pa.array(np.full(len(code), block, np.int32)), "code": pa.array(code)})
    return run


def _add_up(order: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        code, logp = answers.column("code").to_numpy(), answers.column("logp").to_numpy()
        by = np.argsort(code)
        code, logp = code[by], logp[by]
        texts, sums, sizes = docs.column("_text").combine_chunks(), [], []
        model = _other_model(docs.column("_block")[0].as_py())
        for lo, hi in slices(texts):
            doc, codes = byte_codes(texts.slice(lo, hi - lo), order)
            sums.append(np.bincount(doc, weights=logp[np.searchsorted(code, codes | model)] if len(codes) else None, minlength=hi - lo))
            sizes.append(np.bincount(doc, minlength=hi - lo))
        total, size = np.concatenate(sums), np.concatenate(sizes)
        perplexity = np.exp(-total / np.maximum(size, 1))
        return pa.table({
            "_id": docs.column("_id"), "_h": docs.column("_h"), "lang": docs.column("lang"),
            "n_bytes": pa.array(size.astype(np.int64)), "perplexity": pa.array(perplexity, mask=size == 0)})
    return run


def perplexities(docs: DataFrame, shares: DataFrame, left: DataFrame, *, order: int = ORDER,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_id, _h, lang, n_bytes, perplexity) of ``docs`` (_id, _h, lang, _text) by the model of the other fold."""
    size = docs.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    half = max(1, -(-size // (2 * block_bytes)))
    block = F.pmod(F.xxhash64("_id", "_h"), F.lit(half)) * 2 + fold_of(F.col("_h"))
    dealt = docs.withColumn("_block", block.cast("int")).repartition(2 * half, "_block")
    texts = dealt.where(F.col("_text") != "")
    asked = texts.groupBy("_block").applyInArrow(_ask(order), "_block int, code long")
    answers = asked.join(log_probabilities(asked, shares, left, order), "code").select("_block", "code", "logp")
    id_type = docs.schema["_id"].dataType.simpleString()
    lang_type = docs.schema["lang"].dataType.simpleString()
    scored = texts.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        _add_up(order), f"_id {id_type}, _h long, lang {lang_type}, n_bytes long, perplexity double")
    empty = docs.where(F.col("_text") == "").select("_id", "_h", "lang", F.lit(0).cast("long").alias("n_bytes"),
                                                    F.lit(None).cast("double").alias("perplexity"))
    return scored.unionByName(empty)


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(_trusted): ids whose labels all say good quality and not toxic."""
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_trusted")).agg(
        F.bool_and(good).alias("_good")).where("_good").select("_trusted")


def _with_trusted(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.join(ids, F.col("_id") == F.col("_trusted"), how)


def length_band(n_bytes: Column) -> Column:
    """Class of a text's length: each is four times as long as the one below."""
    return F.floor((F.length(F.bin(n_bytes)) - 1) / 2).cast("int")


def thresholds(scores: DataFrame, ids: DataFrame, quantile: float, band_texts: int = BAND_TEXTS) -> DataFrame:
    """(_lang, _band, threshold) of every language and length band, and one row with a null ``_lang`` over all."""
    language = F.coalesce(F.col("lang").cast("string"), F.lit("(none)"))
    trusted = _with_trusted(scores.where(F.col("perplexity").isNotNull()), ids, "inner").select(
        language.alias("_lang"), length_band(F.col("n_bytes")).alias("_band"), F.floor(F.log("perplexity") * BINS).alias("bin"), "_h").distinct()
    bins = trusted.groupBy("_lang", "_band", "bin").count()

    def up_to_quantile(over: list[str]) -> DataFrame:
        """(*over, texts, threshold)."""
        parts = Window.partitionBy(*[F.col(c) for c in over] or [F.lit(0)])
        run = parts.orderBy("bin")  # a few thousand bins a part
        counted = bins.groupBy(*over, "bin").agg(F.sum("count").alias("count")).select(
            *over, "bin", F.sum("count").over(run).alias("up_to"), F.sum("count").over(parts).alias("texts"))
        return counted.where(F.col("up_to") >= F.col("texts") * quantile).groupBy(*over).agg(
            F.max("texts").alias("texts"), F.exp((F.min("bin") + 1) / F.lit(float(BINS))).alias("threshold"))

    bands = up_to_quantile(["_lang", "_band"]).where(F.col("texts") >= band_texts).select(
        "_lang", "_band", F.col("threshold").alias("_own"))
    languages = up_to_quantile(["_lang"]).select("_lang", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_band"), "threshold")
    return languages.join(bands, ["_lang", "_band"], "left").select(
        "_lang", "_band", F.coalesce("_own", "threshold").alias("threshold")).unionByName(
        up_to_quantile([]).where(F.col("threshold").isNotNull()).select(
            F.lit(None).cast("string").alias("_lang"), F.lit(None).cast("int").alias("_band"), "threshold"))


def judge_quality(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
                  order: int = ORDER, quantile: float = QUANTILE, band_texts: int = BAND_TEXTS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_id, _h, lang, n_bytes, perplexity, threshold, keep) of every row of ``docs``."""
    ids = written(trusted_ids(labels, key), "trusted")
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(text_of(F.col(text))).alias("_h"), F.col(lang).alias("lang"),
                       text_of(F.col(text)).alias("_text"))
    shares, left = kneser_ney(count_grams(
        _with_trusted(rows, ids, "left_semi").withColumn("_fold", fold_of(F.col("_h"))), order), order)
    scores = written(perplexities(rows, shares, left, order=order, block_bytes=block_bytes), "scores")
    limits = written(thresholds(scores, ids, quantile, band_texts), "thresholds")  # 32 rows a language
    overall = limits.where(F.col("_lang").isNull()).first()
    language = F.coalesce(F.col("lang").cast("string"), F.lit("(none)"))
    own = limits.where(F.col("_lang").isNotNull())
    judged = scores.join(own, (language == F.col("_lang")) & (length_band(F.col("n_bytes")) == F.col("_band")), "left").drop("_lang", "_band")
    return judged.withColumn("threshold", F.coalesce("threshold", F.lit(overall["threshold"] if overall else math.inf))).withColumn(
        "keep", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))


def drop_poor(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rejected ones."""
    kept = judge_quality(docs, labels, key=key, text=text, **options).where("keep").select("_id", "_h").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_k"),
                         F.xxhash64(text_of(F.col(text))).alias("_g"))
    return packed.join(kept.hint("shuffle_hash"), F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_g") == F.col("_h")),
                       "left_semi").select("_row.*")


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        F.col("_id").alias("doc_id"), "lang", "n_bytes", "perplexity", "threshold", "keep")
