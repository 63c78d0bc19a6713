"""Quality rules: document statistics, fixed base rules, and gradient-boosted trees with monotonic constraints.

How it works. One pass over the whole texts counts words, characters, symbols, repeated lines and words in
repeated five-word windows, and writes them (some hundred bytes a document). Trees are boosted on shares of
these counts (logistic loss, Newton leaves, binned thresholds), on at most ``SAMPLE`` labelled documents of
either class; the sample's classes are weighted to their numbers in all labels. Chance of poor quality may not
fall when a feature of ``RISING`` grows: a split on such a feature must put the smaller value left, and all
values below it stay on their side of the middle. The fitted trees are flat node arrays; scoring moves all rows
of a batch and all trees down one level at a time. A document is kept if it meets the base rules and its
chance is below ``POOR``.

At scale: texts never shuffle; the sample is the only thing collected, bounded by the parameter (labels are
sampled by a hash of their id before they meet the documents, by a broadcast of at most twice ``SAMPLE`` ids,
and the matches are cut to the same bound, so a hot id can't enlarge it). Statistics, base rules and scores
cover all documents. Tasks hold one text at a time besides the Arrow batch: its words as numbers.

Defined results: null text counts as empty (no words, so it fails the base rules); repeated rows and ids are rows
of their own; labels with a null id or a quality other than 0 and 1 are left out, a document labelled both ways
counts as poor. Without labels of both classes the base rules decide alone. Extra columns play no role.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

SAMPLE = 10_000
TREES, DEPTH, RATE, BINS, LEAST, SHRINK = 60, 3, 0.15, 64, 15, 1.0
POOR = 0.8
WINDOW, PIECE = 5, 1 << 20

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MARKS = b"!\"'()+,-./:;=?@[\\]^_`{}~"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
CONTINUED = bytes(range(128, 192))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_upper", "n_digits", "n_marks",
          "n_lines", "n_distinct"]
FEATURES = ["symbols_a_word", "dup_lines", "repeat_words", "upper", "digits", "marks", "word_length", "line_words",
            "distinct", "size"]
RISING = ["symbols_a_word", "dup_lines", "repeat_words", "upper", "digits"]


# ---------------------------------------------------------------- statistics of one text

def word_numbers(raw: bytes) -> tuple[np.ndarray, int]:
    """The text's words as numbers (equal words, equal numbers), and how many different ones there are."""
    seen: dict[bytes, int] = {}
    parts, begin = [], 0
    cut = re.compile(rb"[ \t-\r]")
    while begin < len(raw):
        stop = cut.search(raw, begin + PIECE)  # a piece ends at white space
        end = stop.start() if stop else len(raw)
        piece = raw[begin:end].split()
        parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in piece), np.int64, len(piece)))
        begin = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), len(seen)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (a, b): equal pairs, equal numbers."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated_words(numbers: np.ndarray, k: int = WINDOW) -> int:
    """Words that lie in a window of ``k`` words which the text holds twice or more, the first one included."""
    n = len(numbers) - k + 1
    if n < 2:
        return 0
    window = numbers[:n]
    for i in range(1, k):
        window = _pairs(window, numbers[i: i + n])
    hit = np.bincount(window)[window] > 1
    covered = np.zeros(len(numbers), bool)
    for i in range(k):
        covered[i: i + n] |= hit
    return int(covered.sum())


def statistics(raw: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one UTF-8 text."""
    without = lambda drop: len(raw.translate(None, drop))
    numbers, distinct = word_numbers(raw)
    lines, n_lines = set(), 0
    for m in re.finditer(rb"[^\n]+", raw):
        if m[0].strip():  # white space of bytes is the six characters of SPACE
            lines.add(m[0])
            n_lines += 1
    return (len(numbers), without(CONTINUED + SPACE), len(raw) - without(SYMBOLS), n_lines - len(lines), repeated_words(numbers),
            without(CONTINUED), len(raw) - without(UPPER), len(raw) - without(DIGITS), len(raw) - without(MARKS), n_lines, distinct)


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``COUNTS``) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            rows = [statistics(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in texts]
            table = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, table.T)], names=["id", *COUNTS])

    schema = "id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def features(counts: np.ndarray) -> np.ndarray:
    """``FEATURES`` of rows of ``COUNTS``."""
    c = dict(zip(COUNTS, np.asarray(counts, np.float64).T))
    share = lambda a, b: c[a] / np.maximum(c[b], 1)
    return np.column_stack([share("n_symbols", "n_words"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
                            share("n_upper", "n_chars"), share("n_digits", "n_chars"), share("n_marks", "n_chars"),
                            share("word_chars", "n_words"), share("n_words", "n_lines"), share("n_distinct", "n_words"),
                            np.log1p(c["n_words"])])


# ---------------------------------------------------------------- boosted trees

@dataclass
class Trees:
    """All trees as flat arrays: a node's feature and threshold, its left child (the right one follows it), its value.

    A leaf is its own left child with a threshold of infinity. ``roots`` has the root of each tree.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def chance(self, x: np.ndarray) -> np.ndarray:
        """Chance of poor quality for each row: all rows and trees go down one level a step."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[rows, self.feature[at]] > self.threshold[at]
            at = self.left[at] + right
        return 1.0 / (1.0 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def _best_split(g: np.ndarray, h: np.ndarray, count: np.ndarray, low: float, high: float, sign: np.ndarray, least: int):
    """Best (gain, feature, bin, left value, right value) from per-feature, per-bin sums; None if no split helps."""
    value = lambda a, b: np.clip(-a / (b + SHRINK), low, high)
    gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in (g, h, count))
    gt, ht, nt = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None], count.sum(axis=1)[:, None]
    vl, vr, v0 = value(gl, hl), value(gt - gl, ht - hl), value(gt, ht)
    loss = lambda a, b, v: a * v + 0.5 * (b + SHRINK) * v * v
    gain = loss(gt, ht, v0) - loss(gl, hl, vl) - loss(gt - gl, ht - hl, vr)
    allowed = (nl >= least) & (nt - nl >= least) & (sign[:, None] * (vr - vl) >= 0)
    gain = np.where(allowed, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape) if gain.size else (0, 0)
    return (f, b, vl[f, b], vr[f, b]) if gain.size and gain[f, b] > 1e-9 else None


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, sign: np.ndarray, *, trees: int = TREES, depth: int = DEPTH,
              rate: float = RATE, bins: int = BINS, least: int = LEAST) -> Trees:
    """Boost regression trees on the logistic loss; ``sign`` is 1, -1 or 0 for a rising, falling or free feature."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    width = max(len(e) for e in edges) + 1
    p = float(np.average(y, weights=weight))
    start = float(np.log(p / (1 - p)))
    score = np.full(len(x), start)
    roots, feature, threshold, left, leaf = [], [], [], [], []

    def node(v: float) -> int:
        feature.append(0), threshold.append(np.inf), left.append(len(left)), leaf.append(v)
        return len(left) - 1

    for _ in range(trees):
        chance = 1.0 / (1.0 + np.exp(-score))
        g, h = weight * (chance - y), weight * chance * (1 - chance)
        root = node(float(-g.sum() / (h.sum() + SHRINK)))
        roots.append(root)
        level = [(root, np.arange(len(x)), -np.inf, np.inf)]
        for _ in range(depth):
            below = []
            for at, rows, low, high in level:
                sums = [np.array([np.bincount(binned[rows, f], w, width) for f in range(x.shape[1])])
                        for w in (g[rows], h[rows], np.ones(len(rows)))]
                best = _best_split(*sums, low, high, sign, least)
                if best is None:
                    continue
                f, b, vl, vr = best
                middle = (vl + vr) / 2
                go_left = binned[rows, f] <= b
                lo, hi = node(vl), node(vr)
                feature[at], threshold[at], left[at] = f, float(edges[f][b]), lo
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}[int(sign[f])]
                below += [(lo, rows[go_left], *bounds[0]), (hi, rows[~go_left], *bounds[1])]
            level = below
        model = Trees(np.array([root]), *map(np.array, (feature, threshold, left, leaf)), 0.0, depth)
        at = np.full(len(x), root)
        for _ in range(depth):
            at = model.left[at] + (x[np.arange(len(x)), model.feature[at]] > model.threshold[at])
        score += rate * model.value[at]
    return Trees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), rate * np.array(leaf), start, depth)


# ---------------------------------------------------------------- Spark

def training_rows(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, classes (1: poor) and weights of at most ``sample`` labelled documents of either class."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(
        F.col("doc_id").cast("long").alias("l_id")).agg(F.min("quality").alias("quality"))
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    order = [F.xxhash64(F.lit("quality rules"), "l_id"), "l_id"]
    some = known.where("quality = 0").orderBy(*order).limit(sample).unionByName(
        known.where("quality = 1").orderBy(*order).limit(sample))
    met = stats.join(F.broadcast(some), F.col("id") == F.col("l_id"))
    got = met.select("quality", *COUNTS).orderBy(F.xxhash64("id", *COUNTS), "quality").limit(2 * sample).toArrow()
    counts = np.column_stack([got[c].to_numpy() for c in COUNTS]) if len(got) else np.zeros((0, len(COUNTS)), np.int64)
    poor = (got["quality"].to_numpy() == 0).astype(np.float64)
    weight = np.ones(len(poor))
    if 0 < poor.sum() < len(poor):
        for k, quality in ((1, 0), (0, 1)):
            weight[poor == k] = sizes[quality] / (poor == k).sum()
        weight *= len(weight) / weight.sum()
    return counts, poor, weight


def fit_rules(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees fitted on labelled documents; None without documents of both classes."""
    counts, poor, weight = training_rows(stats, labels, sample)
    if not 0 < poor.sum() < len(poor):
        return None
    return fit_trees(features(counts), poor, weight, np.array([int(f in RISING) for f in FEATURES]))


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", poor: float = POOR) -> DataFrame:
    """(key, n_words, the four base counts, base_failed, kept, chance of poor quality) of every document."""
    stats = written(document_statistics(docs, key, text), "quality-statistics")
    model = fit_rules(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.column_stack([batch.column(c).to_numpy() for c in COUNTS])
            chance = pa.nulls(len(counts), pa.float64()) if model is None else pa.array(model.chance(features(counts)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ["id", *COUNTS[:5]]), chance],
                                             names=["id", *COUNTS[:5], "chance"])

    scored = stats.mapInArrow(run, "id long, " + ", ".join(f"{c} long" for c in COUNTS[:5]) + ", chance double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select(F.col("id").alias(key), *COUNTS[:5], failed.alias("base_failed"),
                         (~failed & (F.coalesce("chance", F.lit(0.0)) < poor)).alias("kept"), F.col("chance").alias("poor_chance"))


def op12_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
