"""Toxicity by the nearest labelled examples.

The space is TF-IDF over stems: the first 5 letters of lower-case words (a letter of a
script without spaces is a word).  The terms are all stems of the labelled examples;
document frequencies come from all documents.  Examples lie in an inverted block-max index: alike examples share a block of at most ``BLOCK``; terms of at least
``1 / COMMON`` of the examples are rows of a matrix, the others postings by term and block with
the highest weight of every term in every block.  The product of the common terms and those maxima
bound the cosines of a block: blocks that cannot reach the k-th nearest are skipped.  The others get
their cosines in single precision; those within ``MARGIN`` of the k-th best are summed again in
double, so the k nearest by cosine are exact.  Votes are weighted by nearness
and calibrated by an isotonic fit of the examples' own leave-one-out votes.

Bounds (parameters): at most about ``max_examples`` examples of either label,
chosen by a hash of the id over all labelled rows; the calibration uses every
n-th example, about ``CALIBRATED`` of them.  The index is collected and broadcast; it
holds the examples' distinct stems, so its size is bounded by the number and length of
the examples.

Defined results: texts without any term of the examples (null and empty ones too)
get the share of toxic examples among those without any, drawn to the share among all
labelled rows.  Stems that no example has are no terms, and not in a text's norm.
Texts are read whole.  Equal texts
get equal scores; ties among examples go to the smaller doc_id.  Without any
usable label every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import Shared, crc_remainder, written

FOLDS, HELD_OUT = 4, 2
PIECE, WIDE, K = 5, 0x2E80, 15
COMMON, MARGIN = 8, 2e-4
BLOCK, GAP, PROJECTED = 256, 4, 48
THRESHOLD = 0.3
SLICE_CHARS, CALIBRATED = 500_000, 2000
VECTOR = "struct<term:array<int>,tf:array<int>>"
FACTORS = np.random.default_rng(3).integers(1 << 62, 1 << 63, PIECE, dtype=np.uint64) | np.uint64(1)


def letter_table() -> np.ndarray:
    """Code point -> itself if it is a letter, else 0.  Made once and
    broadcast (4 MB): functions reach the workers anew with every task."""
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.arange(0x110000, dtype=np.uint32), 0).astype(np.uint32)


def pieces(texts, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All terms of the texts: (index of the text, hash of the term), in order.  A term
    is the first PIECE letters of a word; a letter of a script from WIDE on is a word."""
    lines = [f" {t.lower()} " if t else "  " for t in texts]
    code = np.frombuffer(("".join(lines) + " " * PIECE).encode("utf-32-le", "replace"), np.uint32)
    code = letters[code]
    letter, wide = code != 0, code >= WIDE
    at = np.flatnonzero(letter[1:] & (~letter[:-1] | wide[1:] | wide[:-1])) + 1
    total = code[at] * FACTORS[0]
    inside = ~wide[at]
    for i in range(1, PIECE):
        inside &= letter[at + i] & ~wide[at + i]
        total += np.where(inside, code[at + i], 0) * FACTORS[i]
    ends = np.cumsum([len(x) for x in lines])
    return np.searchsorted(ends, at, side="right"), total


def slices(texts: pa.Array):
    """The texts as lists of strings of about SLICE_CHARS characters; those of
    one slice only are in memory as strings."""
    start, size = 0, 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        size += n or 0
        if size >= SLICE_CHARS:
            yield texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0
    if start < len(texts):
        yield texts.slice(start).to_pylist()


# ---------------------------------------------------------------- examples
def sample_labelled(labels: DataFrame, label: str, folds: int, held_out: int, bound: int) -> tuple[DataFrame, dict]:
    """(doc_id, y) outside the held-out fold, about ``bound`` ids of either label,
    and the share of each label's ids that is kept."""
    y = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
               .filter(crc_remainder("doc_id", folds) != held_out)
               .groupBy("doc_id").agg(F.max(label).alias("y")))
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = {k: min(1.0, bound / n) for k, n in counts.items()}
    unit = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("y") == 1, keep.get(1, 1.0)).otherwise(keep.get(0, 1.0))
    return y.filter(unit < rate), keep


def _distinct_pieces(batches, letters):
    for batch in batches:
        for texts in slices(batch.column(0)):
            terms = np.unique(pieces(texts, letters.value)[1]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(terms)], names=["term"])


def vocabulary(examples: DataFrame, letters) -> np.ndarray:
    """All terms (hashes, ascending) of the examples."""
    found = examples.select("text").mapInArrow(lambda b: _distinct_pieces(b, letters), "term long").distinct()
    return np.sort(found.toArrow()["term"].to_numpy().view(np.uint64))


# ---------------------------------------------------------------- vectors
class Terms:
    """Finds the terms in texts, by a table over the first bits of their hashes."""
    SHIFT = np.uint64(43)

    def __init__(self, terms: np.ndarray, letters: np.ndarray):
        self.terms, self.letters = terms, letters
        slot = (terms >> self.SHIFT).astype(np.int64)
        self.first = np.zeros(1 << 21, np.int32)             # slot -> its first term
        self.first[slot[::-1]] = np.arange(len(terms), dtype=np.int32)[::-1]
        self.crowded = np.bincount(slot, minlength=1 << 21) > 1

    def found(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the text, number of the term, count), in that order."""
        doc, piece = pieces(texts, self.letters)
        slot = (piece >> self.SHIFT).astype(np.int64)
        at = self.first[slot].astype(np.int64)
        rest = np.flatnonzero((self.terms[at] != piece) & self.crowded[slot])
        at[rest] = np.minimum(np.searchsorted(self.terms, piece[rest]), len(self.terms) - 1)
        hit = self.terms[at] == piece
        pairs, n = np.unique(doc[hit] * len(self.terms) + at[hit], return_counts=True)
        doc, term = np.divmod(pairs, len(self.terms))
        return doc, term.astype(np.int32), n.astype(np.int32)

    def each(self, texts: list) -> tuple[list, list]:
        """Term numbers and counts of each text."""
        none = np.zeros(0, np.int32)
        terms, tfs = [none] * len(texts), [none] * len(texts)
        if len(self.terms):
            doc, term, tf = self.found(texts)
            edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1)) if len(doc) else []
            for i, j in zip(edges[:-1], edges[1:]):
                terms[doc[i]], tfs[doc[i]] = term[i:j], tf[i:j]
        return terms, tfs

    def vectors(self, texts: pa.Array) -> pa.Array:
        term, tf = [], []
        for part in slices(texts):
            terms, tfs = self.each(part)
            term += terms
            tf += tfs
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array(term, kind), pa.array(tf, kind)], names=["term", "tf"])


def frequencies(docs: DataFrame, shared, terms: int) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents."""
    def count(batches):
        known, total, rows = Terms(*shared.value), np.zeros(terms, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for texts in slices(batch.column(0)) if terms else ():
                total += np.bincount(known.found(texts)[1], minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], rows))],
                                         names=["term", "n"])

    counts = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(terms + 1, np.int64)
    df[counts["term"].to_numpy()] = counts["n"].to_numpy()
    return df[:-1], int(df[-1])


def vectors(text: Column, shared) -> Column:
    """Term numbers and counts of each text; ``shared`` broadcasts the terms
    and the letter table."""
    made: list = []

    @F.arrow_udf(VECTOR)
    def one(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Terms(*shared.value))
        return made[0].vectors(texts)
    return one(text)


# ---------------------------------------------------------------- index
def halved(place: np.ndarray, some: np.ndarray) -> list[np.ndarray]:
    """Rows in groups of at most BLOCK: halves along the direction in which they differ most."""
    if len(some) <= BLOCK:
        return [some]
    off = place[some] - place[some].mean(axis=0)
    order = some[np.argsort(off @ np.linalg.eigh(off.T @ off)[1][:, -1], kind="stable")]
    return halved(place, order[:len(order) // 2]) + halved(place, order[len(order) // 2:])


def stretches(alive: np.ndarray) -> list[tuple[int, int]]:
    """Runs (first block, end) that cover the live blocks; gaps of up to GAP blocks are read over."""
    at = np.flatnonzero(alive)
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at) > GAP + 1)
    return list(zip(at[np.append(0, new + 1)].tolist(), (at[np.append(new, len(at) - 1)] + 1).tolist()))


@dataclass
class Index:
    """Block-max inverted index over the examples' unit vectors."""
    idf: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    y: np.ndarray = field(default_factory=lambda: np.zeros(0))
    start: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))   # of each example in the next two
    term: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    tf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    norm: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))   # where each block of examples starts
    lists: tuple | None = None                       # made from these, once in a process
    prior: float = 0.0

    def weights(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Unit vector: (1 + ln tf) * idf."""
        w = (1 + np.log(tf)) * self.idf[term]
        return w / np.sqrt((w * w).sum())

    def add(self, ids: list, y: list, terms: list, tfs: list) -> None:
        """Index the examples, alike ones in one block."""
        order = sorted(range(len(ids)), key=lambda e: ids[e])
        if order:
            drawn = np.random.default_rng(4).standard_normal((len(self.idf), PROJECTED), np.float32)
            place = np.stack([self.weights(terms[e], tfs[e]) @ drawn[terms[e]] for e in order])
            leaves = halved(place, np.arange(len(order)))
            order = [order[i] for leaf in leaves for i in leaf]
            self.block = np.cumsum([0] + [len(leaf) for leaf in leaves])
        self.ids, self.y = np.array(ids, np.int64)[order], np.array(y, np.float64)[order]
        self.start = np.cumsum([0] + [len(terms[e]) for e in order])
        if not order:
            return
        self.term = np.concatenate([terms[e] for e in order]).astype(np.int32)
        self.tf = np.concatenate([tfs[e] for e in order])
        self.norm = np.array([np.sqrt((((1 + np.log(tfs[e])) * self.idf[terms[e]]) ** 2).sum()) for e in order])
        self.tf = self.tf.astype(np.min_scalar_type(self.tf.max()))

    def made(self) -> tuple:
        """(row of each term in the matrix or -1, matrix of the common terms by example,
        postings of the others by term and example, first posting of each term in each block,
        highest weight of each term in each block, 1 + ln tf by tf).  A posting is an example and its weight in single precision,
        side by side in 64 bits."""
        if self.lists is None:
            n, terms, blocks = len(self.ids), len(self.idf), len(self.block) - 1
            common = np.flatnonzero(np.bincount(self.term, minlength=terms) * COMMON >= n)
            row = np.full(terms, -1, np.int32)
            row[common] = np.arange(len(common), dtype=np.int32)
            # in place and in small types, as every worker makes its own lists
            example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.start))
            weight = np.log(self.tf, dtype=np.float32)
            weight += 1
            weight *= self.idf.astype(np.float32)[self.term]
            weight /= self.norm.astype(np.float32)[example]
            dense = row[self.term] >= 0
            matrix = np.zeros((len(common), n), np.float32)
            matrix[row[self.term[dense]], example[dense]] = weight[dense]
            dense = ~dense
            term, example, weight = self.term[dense], example[dense], weight[dense]
            by_term = np.argsort(term, kind="stable").astype(np.int32)
            pair = np.empty((len(term), 2), np.int32)
            pair[:, 0], pair[:, 1] = example[by_term], weight[by_term].view(np.int32)
            key = term[by_term] * np.int64(blocks)
            del dense, term, example, weight, by_term
            key += np.repeat(np.arange(blocks), np.diff(self.block))[pair[:, 0]]
            first = np.zeros(terms * blocks + 1, np.int32)
            np.cumsum(np.bincount(key, minlength=terms * blocks), out=first[1:])
            highest = np.zeros(terms * blocks, np.float32)
            edge = np.flatnonzero(np.diff(key, prepend=-1))
            if len(edge):
                highest[key[edge]] = np.maximum.reduceat(pair[:, 1].view(np.float32), edge)
            counts = 1 + np.log(np.arange(1, int(self.tf.max()) + 1, dtype=np.float64))
            self.lists = (row, matrix, pair.reshape(-1).view(np.int64), first, highest.reshape(terms, blocks),
                          np.append(0.0, counts))
        return self.lists

    def rough(self, queries: list, k: int, without: list | None) -> np.ndarray:
        """Cosine of every query, as (terms, weights), and every example, in single precision;
        -1 for those in blocks that cannot hold one of the k nearest, and for example ``without[q]``."""
        row, matrix, postings, first, highest, _ = self.made()
        blocks, size = len(self.block) - 1, np.diff(self.block)
        common = np.zeros((len(queries), len(matrix)), np.float32)
        for q, (term, w) in enumerate(queries):
            at = row[term]
            common[q, at[at >= 0]] = w[at >= 0]
        scores, weight = common @ matrix, np.zeros(len(self.idf))
        for q, (term, w) in enumerate(queries):
            score, alive = scores[q], np.ones(blocks, bool)
            if without:
                score[without[q]] = -1
            rare = row[term] < 0
            rare, w32 = term[rare], w[rare].astype(np.float32)
            if len(score) - bool(without) > k:
                # the k best by common terms: the k-th nearest is no farther than the worst of them
                seeds = np.argpartition(score, -k)[-k:]
                weight[term] = w * self.idf[term]
                least = self.exact(seeds, weight).min() - MARGIN
                weight[term] = 0
                alive = np.maximum.reduceat(score, self.block[:-1]) + w32 @ highest[rare] >= least
            cuts, most = [], []
            for a, b in stretches(alive):
                i, j = first[rare * np.int64(blocks) + a], first[rare * np.int64(blocks) + b]
                some = np.flatnonzero(j > i)
                cuts += [postings[x:y] for x, y in zip(i[some].tolist(), j[some].tolist())]
                most.append(np.repeat(w32[some], j[some] - i[some]))
            if cuts:
                found = np.concatenate(cuts)
                part = found.view(np.float32)[1::2] * np.concatenate(most)
                np.add.at(score, found.view(np.int32)[0::2].astype(np.intp), part)
            if without:
                score[without[q]] = -1
            if not alive.all():
                score[np.repeat(~alive, size)] = -1
        return scores

    def exact(self, some: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cosines of some examples with a query (weight times idf, by term), to 12 places."""
        log_tf = self.made()[5]
        cuts = [slice(a, b) for a, b in zip(self.start[some].tolist(), self.start[some + 1].tolist())]
        part = log_tf[np.concatenate([self.tf[c] for c in cuts])]
        part *= query[np.concatenate([self.term[c] for c in cuts])]
        size = self.start[some + 1] - self.start[some]
        return np.round(np.add.reduceat(part, np.cumsum(size) - size) / self.norm[some], 12)

    def nearest_of(self, vecs: list, k: int = K, without: list | None = None) -> list:
        """Exact k nearest examples (numbers, cosines) of each vector, best first."""
        queries = [(term, self.weights(term, tf)) for term, tf in vecs]
        out, weight = [], np.zeros(len(self.idf))
        for q, score in enumerate(self.rough(queries, k, without)):
            least = np.partition(score, -k)[-k] - MARGIN if len(score) > k else 0
            some = np.flatnonzero((score >= least) & (score > 0))
            if not len(some):
                out.append((some, np.zeros(0)))
                continue
            term, w = queries[q]
            weight[term] = w * self.idf[term]
            s = self.exact(some, weight)
            weight[term] = 0
            order = np.lexsort((self.ids[some], -s))[:k]
            out.append((some[order], s[order]))
        return out

    def nearest(self, term: np.ndarray, tf: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_of([(term, tf)], k)[0]

    def vote(self, e: np.ndarray, s: np.ndarray) -> float:
        """Share of toxic examples among the nearest, weighted by nearness,
        drawn to the prior where all of them are far."""
        w = s * s
        return float(((w * self.y[e]).sum() + 0.25 * self.prior) / (w.sum() + 0.25))

    def vec(self, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and counts of an example."""
        at = slice(self.start[e], self.start[e + 1])
        return self.term[at], self.tf[at].astype(np.int64)

    @property
    def vecs(self) -> list:
        return [self.vec(e) for e in range(len(self.ids))]

    def own_votes(self, examples: list[int]) -> list[float]:
        """The votes that some examples get from all others."""
        found = self.nearest_of([self.vec(e) for e in examples], without=examples)
        return [self.vote(*f) for f in found]


def calibrated(spark, index: Shared, n: int, y: np.ndarray, prior: float, weight: dict) -> tuple:
    """Isotonic fit (pool adjacent violators) of labels on the votes that
    examples get from all others: (votes, shares) to interpolate.  Every n-th example, about
    ``CALIBRATED``, votes on the executors; only its number and vote come back.
    ``weight``: how many labelled rows an example of a label stands for."""
    some = list(range(0, n, max(1, n // CALIBRATED)))
    if not some:
        return (0.0, 1.0), (0.0, 1.0)

    def ask(batches):
        for pdf in batches:
            for i in range(0, len(pdf), 100):
                part = pdf["e"].iloc[i:i + 100].tolist()
                yield pd.DataFrame({"e": part, "vote": index.value.own_votes(part)})

    parts = -(-len(some) // 100)
    asked = spark.createDataFrame([(e,) for e in some], "e long").repartition(parts, F.col("e"))
    votes = sorted((r["vote"], r["e"]) for r in asked.mapInPandas(ask, "e long, vote double").collect())   # about CALIBRATED
    pools: list[list[float]] = []            # weight, toxic weight, sum of votes
    for v, e in votes:
        w = weight[int(y[e])]
        pools.append([w, w * y[e], w * v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[2] / p[0] for p in pools], [(p[1] + 0.1 * prior) / (p[0] + 0.1) for p in pools]


def share_of(vote: float, curve: tuple) -> float:
    """The calibrated score of a vote."""
    return float(min(1.0, max(0.0, 0.98 * np.interp(vote, *curve) + 0.02 * vote)))


@dataclass
class Model:
    terms: object        # broadcast terms and letter table
    index: object        # shared Index
    curve: tuple         # calibration: votes, shares


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_examples: int = 5000) -> Model:
    spark = docs.sparkSession
    chosen, keep = sample_labelled(labels, label, FOLDS, HELD_OUT, max_examples)
    # at most about 2 * max_examples ids
    examples = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    examples = (examples.groupBy(F.xxhash64("text").alias("th"))      # copies count once
                        .agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("y").alias("y")))
    examples = written(examples, "toxic-examples")
    letters = spark.sparkContext.broadcast(letter_table())
    found = vocabulary(examples, letters)
    terms = spark.sparkContext.broadcast((found, letters.value))
    df, n = frequencies(docs, terms, len(found))
    index = Index(np.log((n + 1) / (df + 1)) + 1)
    rows = (examples.select("doc_id", "y", vectors(F.col("text"), terms).alias("vec"))
                    .select("doc_id", "y", "vec.term", "vec.tf").toArrow().to_pandas())
    weight = {y: 1 / (keep.get(y) or 1.0) for y in (0, 1)}
    stands = rows["y"].map(weight).astype(float)
    bare = rows["term"].map(len) == 0
    every = float((stands * rows["y"]).sum() / max(stands.sum(), 1))
    index.prior = float(((stands * rows["y"])[bare].sum() + every) / (stands[bare].sum() + 1))
    rows = rows[~bare.astype(bool)]
    index.add(rows["doc_id"].tolist(), rows["y"].tolist(), rows["term"].tolist(), rows["tf"].tolist())
    n, y, prior = len(index.ids), index.y, index.prior
    index = Shared(spark, index)
    return Model(terms, index, calibrated(spark, index, n, y, prior, weight))


def scored(text: Column, model: Model) -> Column:
    """struct<score, evidence> of a text; evidence lists the three nearest
    examples as doc_id:label:cosine."""
    terms, index, curve = model.terms, model.index, model.curve
    made: list = []
    seen: dict = {}

    @F.arrow_udf("struct<score:double,evidence:string>")
    def one(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Terms(*terms.value))
        ix, out = index.value, []
        for part in slices(texts):
            vecs = list(zip(*made[0].each(part)))
            keys = [blake2b(term.tobytes() + tf.tobytes(), digest_size=16).digest() for term, tf in vecs]
            if len(seen) > 20_000:
                seen.clear()
            new = {key: v for key, v in zip(keys, vecs) if key not in seen and len(v[0])}
            for key, (e, s) in zip(new, ix.nearest_of(list(new.values())) if new else ()):
                seen[key] = (share_of(ix.vote(e, s), curve), ",".join(
                    f"{ix.ids[i]}:{int(ix.y[i])}:{c:.4f}" for i, c in zip(e[:3], s[:3])))
            out += [seen.get(key, (ix.prior, "")) for key in keys]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in out], pa.float64()),
                                           pa.array([x for _, x in out], pa.string())], names=["score", "evidence"])
    return one(text)


def score_documents(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document."""
    model = fit(docs, labels, **bounds)
    s = docs.select("doc_id", scored(F.col("text"), model).alias("s"))
    return s.select("doc_id", (crc_remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "s.score",
                    F.when(F.col("s.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "s.evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """``docs`` without the documents predicted toxic; same columns."""
    model = fit(docs, labels, **bounds)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    s = docs.select(F.struct(*cols).alias("row"), scored(F.col("text"), model).alias("s"))
    return s.filter(F.col("s.score") < THRESHOLD).select("row.*")
