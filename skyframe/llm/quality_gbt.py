"""Document quality by histogram gradient-boosted trees.

Every text becomes a row of document statistics (lengths, character classes,
word shapes, repetition, lines).  Trees are grown level by level on binned
statistics: histograms of gradients and Hessians per node, statistic and bin give
the best split of every node of a level at once.  All trees have one depth and
are flattened into arrays in heap order, so scoring is a few numpy gathers
per level for a whole batch of documents and all trees.

Bound (parameter): the trees are fitted on at most about ``max_rows`` labelled
rows outside the held-out fold, chosen by a hash of the id; statistics and
scores cover every whole text.

Defined results: null text counts as empty and has statistics 0; equal texts get
equal scores; repeated ids stay repeated; with labels of one class only, or none, the
score is that class's smoothed share for all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import Shared, crc_remainder, written

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "longest_word", "distinct_words", "top_word",
    "upper", "lower", "digit", "blank", "non_ascii", "sentence_marks", "exclamation", "pipes", "commas", "symbols",
    "brackets", "quotes", "slashes", "byte_entropy", "log_lines", "line_words", "distinct_lines", "ended_lines",
    "plain_words", "capital_words", "marked_words", "distinct_triples", "at_signs", "spread")


def _classes() -> np.ndarray:
    """Rows of 0/1 weights: which bytes count for a character class."""
    groups = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\n\r\v\f",
              "".join(map(chr, range(128, 256))), ".?", "!", "|", ",;:", "#$%&*^~=+_", "()[]{}<>", "\"'`", "/\\", "@"]
    out = np.zeros((len(groups), 256))
    for i, g in enumerate(groups):
        out[i, [ord(c) for c in g]] = 1
    return out


CLASSES = _classes()


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, m = len(raw), len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    (upper, lower, digit, blank, other, stops, bang, pipe, comma, symbol, bracket, quote, slash, at) = \
        (CLASSES @ counts).tolist()
    p = counts[counts > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, m)
    distinct = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".?!\"" for x in lines)
    # a word is plain if it has letters only, up to one closing mark; marked if it ends in another sign
    tails = np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)
    heads = np.frombuffer(b"".join(w[:1] for w in words), np.uint8)
    sign = CLASSES[9][tails] + CLASSES[6][tails] + CLASSES[7][tails]
    letter = CLASSES[1] + CLASSES[0] + CLASSES[4]
    triples = len(set(zip(words, words[1:], words[2:]))) / (m - 2) if m > 2 else 1.0
    shouted = sum(w.isupper() for w in distinct) / len(distinct)
    return [np.log1p(n), np.log1p(m), lengths.mean(), lengths.std(), np.log1p(lengths.max()), len(distinct) / m,
            max(np.unique(lengths, return_counts=True)[1]) / m, upper / n, lower / n, digit / n, blank / n, other / n,
            stops / m, bang / m, pipe / m, comma / m, symbol / m, bracket / m, quote / m, slash / m,
            float(-(p * np.log2(p)).sum()), np.log1p(len(lines)), np.log1p(m / max(1, len(lines))),
            len(set(lines)) / max(1, len(lines)), ended / max(1, len(lines)),
            float((letter[tails] * letter[heads]).mean()), shouted, float((sign > 0).mean()), triples, at / m,
            float(CLASSES[0][heads].mean())]


def statistics_of(text: Column) -> Column:
    @F.pandas_udf("array<float>")
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(t), np.float32) for t in texts], dtype=object)
    return one(text)


@dataclass
class Trees:
    """Flattened trees of one depth; node ``i`` has children ``2i+1``, ``2i+2``."""
    feature: np.ndarray      # trees x inner nodes
    cut: np.ndarray          # trees x inner nodes; right if the value is above
    leaf: np.ndarray         # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.feature.size:
            inner, rows = self.feature.shape[1], np.arange(len(x))[:, None]
            tree = np.arange(len(self.feature))[None, :]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            while at[0, 0] < inner if len(x) else False:
                at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.cut[tree, at])
            out = out + self.leaf[tree, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
         ridge: float = 2.0, least: float = 5.0) -> Trees:
    """Boosted trees for the logistic loss."""
    n, width = x.shape if len(x) else (0, len(STATISTICS))
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner = 2 ** depth - 1
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    offset = np.arange(width) * bins
    feature, cut, leaf = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                          np.zeros((trees, inner + 1)))
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            slot = ((at - first)[:, None] * (width * bins) + offset + binned).ravel()
            hist = [np.bincount(slot, np.repeat(v, width), nodes * width * bins).reshape(nodes, width, bins)
                    for v in (g, h)]
            gl, hl = hist[0].cumsum(2), hist[1].cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
            gain[(hl < least * 0.05) | (ht - hl < least * 0.05)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            f, b = best // bins, best % bins
            useful = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            for i in range(nodes):
                if useful[i] and b[i] < len(cuts[f[i]]):
                    feature[t, first + i], cut[t, first + i] = f[i], cuts[f[i]][b[i]]
            node_f = feature[t, at]
            at = 2 * at + 1 + (x[np.arange(n), node_f] > cut[t, at])
        ends = at - inner
        gs, hs = np.bincount(ends, g, inner + 1), np.bincount(ends, h, inner + 1)
        leaf[t] = -rate * gs / (hs + ridge)
        raw = raw + leaf[t][ends]
    return Trees(feature, cut, leaf, base)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 30_000) -> Trees:
    """Fit on the statistics (doc_id, stats) of a bounded hash sample of the
    labelled rows outside the held-out fold."""
    y = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
               .filter(crc_remainder("doc_id", FOLDS) != HELD_OUT)
               .groupBy("doc_id").agg(F.max(label).alias("y")))
    n = y.count()
    unit = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # at most about max_rows ids
    chosen = y.filter(unit < min(1.0, max_rows / max(n, 1)))
    rows = stats.groupBy("doc_id").agg(F.max("stats").alias("stats")).join(chosen, "doc_id").orderBy("doc_id")
    pdf = rows.select("stats", "y").toPandas()
    if not len(pdf):
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return grow(np.stack(pdf["stats"].to_numpy()).astype(np.float64), pdf["y"].to_numpy().astype(np.float64))


def scored(stats: Column, model) -> Column:
    @F.pandas_udf("double")
    def one(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype="float64")
        return pd.Series(model.value.score(np.stack(batch.to_numpy()).astype(np.float64)))
    return one(stats)


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = 30_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = written(docs.select("doc_id", statistics_of(F.col("text")).alias("stats")), "quality-stats")
    model = Shared(docs.sparkSession, fit(stats, labels, max_rows=max_rows))
    out = stats.select("doc_id", (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                       scored(F.col("stats"), model).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
