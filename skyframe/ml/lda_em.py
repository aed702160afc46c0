"""Topic models (LDA) by expectation maximisation over the document-term edges.

The corpus is a table of edges (doc, term, n).  Edges are dealt to chunks by a
hash of their document and packed once; terms live in blocks by their own hash, and a
chunk and a block know, by position, the terms they share.  A round sends each chunk the weights of its terms,
divides the edges' occurrences among the topics there, and sends back what the chunk's terms got, as plain
numbers in a fixed order; neither edges nor words move again.  A term has one entry per chunk, so no task gets a whole
frequent term; a document's edges are in one chunk, at most one a term.  A round's state is written as files and removed
once the round after the next has its own, and its shuffles are removed when it is done.  Only one number per
topic and the log-likelihood reach the driver.

The maximised objective is the log-posterior: the log-likelihood plus the
Dirichlet terms of ``alpha`` and ``eta`` (both above 1).  It never falls.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.operators.graph import rounds
from skyframe.session import checkpoint_dir, shuffles_removed

EDGES_PER_CHUNK = 2_000_000
EDGES_AT_ONCE = 500_000           # edges whose shares a task holds at a time; also the least that is worth a chunk

MESSAGE = "block long, chunk long, f binary, l double, log_theta double"
STATE = "block long, f binary, mass array<double>, log_terms double, l double, log_theta double"


@dataclass
class Topics:
    k: int
    alpha: float
    eta: float
    vocabulary: int
    tokens: float
    docs: DataFrame               # (doc, nd): topic counts of every document
    terms: DataFrame              # (term, nw): topic counts of every term
    mass: list[float]             # topic counts of all tokens
    log_likelihood: list[float] = field(default_factory=list)
    log_posterior: list[float] = field(default_factory=list)

    @property
    def perplexity(self) -> list[float]:
        return [math.exp(-v / self.tokens) for v in self.log_likelihood]

    def term_weights(self) -> DataFrame:
        """(term, topic, weight): P(term | topic)."""
        down = [m + self.vocabulary * (self.eta - 1) for m in self.mass]
        share = F.array(*[(F.col("nw")[i] + (self.eta - 1)) / d for i, d in enumerate(down)])
        return self.terms.select("term", F.posexplode(share).alias("topic", "weight"))

    def doc_topics(self) -> DataFrame:
        """(doc, topics): P(topic | document)."""
        return self.docs.select("doc", _shares(F.col("nd"), self.alpha, self.k).alias("topics"))


def _shares(counts: Column, alpha: float, k: int) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(counts, lambda x: (x + (alpha - 1)) / (total + k * (alpha - 1)))


def fit(edges: DataFrame, k: int, doc: str = "doc_id", term: str = "term", n: str = "n", alpha: float = 1.1,
        eta: float = 1.1, max_rounds: int = 20, tol: float | None = None, seed: int = 1) -> Topics:
    """Topics of ``edges`` after ``max_rounds`` rounds, or when a round lifts
    the log-posterior by less than ``tol`` of itself."""
    if alpha < 1 or eta < 1:
        raise ValueError("alpha and eta must be at least 1")
    spark = edges.sparkSession
    with shuffles_removed(spark):
        return _fit(edges, k, doc, term, n, alpha, eta, max_rounds, tol, seed)


def _fit(edges: DataFrame, k: int, doc: str, term: str, n: str, alpha: float, eta: float, max_rounds: int,
         tol: float | None, seed: int) -> Topics:
    spark = edges.sparkSession
    base = f"{checkpoint_dir(spark)}/lda-{uuid.uuid4().hex}"
    edges.filter(F.col(doc).isNotNull() & F.col(term).isNotNull() & (F.col(n) > 0)).select(
        F.col(doc).alias("doc"), F.col(term).alias("term"), F.col(n).cast("double").alias("n")).write.parquet(f"{base}/edges")
    rows = spark.read.parquet(f"{base}/edges")
    size = rows.count()
    if not size:
        raise ValueError("no edges")
    count = max(-(-size // EDGES_PER_CHUNK), min(spark.sparkContext.defaultParallelism, -(-size // EDGES_AT_ONCE)))
    chunks, words, start = _packed(rows, k, eta, seed, count, base)
    tokens = float(chunks.agg(F.sum("tokens")).first()[0])
    vocabulary = words.agg(F.sum("size")).first()[0]
    now = start
    model: Topics | None = None
    for i in rounds(None):
        *mass, log_terms = now.agg(*[F.sum(F.col("mass")[t]) for t in range(k)], F.sum("log_terms")).first()   # k + 1 numbers
        old = model
        docs = _named(chunks.select((-1 - F.col("chunk")).alias("block"), F.col("docs").alias("names")), now, "doc", "nd", k)
        terms = _named(words.select("block", F.col("terms").alias("names")), now, "term", "nw", k)
        model = Topics(k, alpha, eta, vocabulary, tokens, docs, terms, [float(v) for v in mass],
                       old.log_likelihood if old else [], old.log_posterior if old else [])
        path = f"{base}/round={i}"
        sent = (now.filter("block >= 0").select("block", "f").join(words.select("block", "to", "positions"), "block")
                   .mapInPandas(_weights(k, eta, model.mass, vocabulary), "to long, block long, f binary"))
        own = now.filter("block < 0").select((-1 - F.col("block")).alias("to"), F.lit(-1).cast("long").alias("block"), "f")
        shared = (chunks.select("chunk", "runs", "places", "times", "cuts").groupBy("chunk")
                        .cogroup(sent.unionByName(own).groupBy("to")).applyInPandas(_share_out(k, alpha), MESSAGE))
        _added_up(words, shared, k, eta).write.parquet(path)
        now = spark.read.parquet(path)
        log, log_theta = now.agg(F.sum("l"), F.sum("log_theta")).first()
        prior = (alpha - 1) * log_theta if alpha > 1 else 0.0
        if eta > 1:
            prior += (eta - 1) * (float(log_terms) - vocabulary * sum(math.log(m + vocabulary * (eta - 1)) for m in mass))
        model.log_likelihood.append(float(log))
        model.log_posterior.append(float(log) + prior)
        if i:
            _remove(spark, f"{base}/round={i - 2}" if i > 1 else f"{base}/start")
        done = model.log_posterior
        if i + 1 >= max_rounds or (tol is not None and i and done[-1] - done[-2] <= tol * abs(done[-1])):
            return model


def _packed(rows: DataFrame, k: int, eta: float, seed: int, count: int, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks of edges, blocks of terms, and the counts of the random start."""
    spark = rows.sparkSession
    kinds = dict(rows.dtypes)
    # a start that depends on the edge only: the same after a retry
    coin = [F.pmod(F.xxhash64("doc", "term", F.lit(i), F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20)) + 0.01 for i in range(k)]
    # the coins are tossed after the shuffle
    dealt = rows.select(F.pmod(F.xxhash64("doc"), F.lit(count)).alias("chunk"), "doc", "term", "n").repartition("chunk")
    tossed = dealt.select("*", F.pmod(F.xxhash64("term"), F.lit(count)).cast("int").alias("home"), *[c.alias(f"g{i}") for i, c in enumerate(coin)])
    schema = (f"chunk long, docs array<{kinds['doc']}>, needs array<array<{kinds['term']}>>, runs binary, places binary, "
              "times binary, cuts binary, tokens double, nd binary, nw binary")
    tossed.groupBy("chunk").applyInArrow(_pack(k, count), schema).write.parquet(f"{base}/packed")
    packed = spark.read.parquet(f"{base}/packed")
    _remove(spark, f"{base}/edges")

    def kept(df: DataFrame, key: str, name: str) -> DataFrame:
        table = f"lda_{name}_{uuid.uuid4().hex}"
        df.write.option("path", f"{base}/{name}").bucketBy(min(count, 50_000), key).saveAsTable(table)
        return spark.table(table)

    chunks = kept(packed.select("chunk", "docs", "runs", "places", "times", "cuts", "tokens"), "chunk", "chunks")
    needs = packed.select(F.col("chunk").alias("to"), F.posexplode("needs").alias("block", "wanted")).filter(F.size("wanted") > 0)
    words = kept(needs.select(F.col("block").cast("long").alias("block"), "to", "wanted").groupBy("block").applyInArrow(
        _link, f"block long, terms array<{kinds['term']}>, size long, to array<long>, positions array<binary>"), "block", "terms")
    _added_up(words, packed.select("chunk", "cuts", "nd", "nw").mapInPandas(_begin(k), MESSAGE), k, eta).write.parquet(f"{base}/start")
    _remove(spark, f"{base}/packed")
    return chunks, words, spark.read.parquet(f"{base}/start")


def _added_up(words: DataFrame, shared: DataFrame, k: int, eta: float) -> DataFrame:
    """The counts that the chunks' messages add up to: one row a block of terms and one a chunk."""
    return (words.select("block", "size", "to", "positions").groupBy("block")
                 .cogroup(shared.groupBy("block")).applyInPandas(_add_up(k, eta), STATE))


def _named(names: DataFrame, state: DataFrame, name: str, counts: str, k: int) -> DataFrame:
    """(name, counts): the names of a chunk or block, each with its k counts of the state."""
    def run(batches):
        for pdf in batches:
            for found, f in zip(pdf["names"], pdf["f"]):
                yield pd.DataFrame({name: found, counts: list(_numbers(f, k))})
    kind = dict(names.dtypes)["names"].removeprefix("array<")[:-1]
    return names.join(state.select("block", "f"), "block").select("names", "f").mapInPandas(run, f"{name} {kind}, {counts} array<double>")


def _remove(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _numbers(f: bytes, k: int) -> np.ndarray:
    return np.frombuffer(f, "<f8").reshape(-1, k)


def _added(place: np.ndarray, shares: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(place, shares[:, t], n) for t in range(shares.shape[1])], 1)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(position of each value among the distinct ones, the distinct ones)."""
    found = values.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


def _pack(k: int, count: int):
    """All edges of a chunk -> one row, in order of the document and of the terms' blocks, with the counts of the start."""
    def run(table: pa.Table) -> pa.Table:
        d, docs = _codes(_flat(table["doc"]))
        t, terms = _codes(_flat(table["term"]))
        home = np.empty(len(terms), np.int64)
        home[t] = table["home"].to_numpy()
        order = np.argsort(home, kind="stable")
        cuts = np.searchsorted(home[order], np.arange(count + 1))
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        # an edge that repeats has the same coins each time
        key, first, which = np.unique(d * np.int64(len(terms)) + place[t], return_index=True, return_inverse=True)
        n = np.bincount(which, table["n"].to_numpy(), len(key))
        d, t = np.divmod(key, len(terms))
        start = np.stack([table[f"g{i}"].to_numpy()[first] for i in range(k)], 1)
        shares = start * (n / start.sum(1))[:, None]
        needs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), terms.take(pa.array(order)))
        small = n.max() < 256 and bool((n == np.floor(n)).all())
        row = {"chunk": table["chunk"][:1], "docs": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
               "needs": pa.ListArray.from_arrays(pa.array([0, count], pa.int32()), needs),
               "runs": [_bytes(np.bincount(d, minlength=len(docs)), "<u4")], "places": [_bytes(t, "<u4")],
               "times": [_bytes(n, "<u1" if small else "<f8")], "cuts": [_bytes(cuts, "<u4")], "tokens": [float(n.sum())],
               "nd": [_bytes(_added(d, shares, len(docs)), "<f8")], "nw": [_bytes(_added(t, shares, len(terms)), "<f8")]}
        return pa.table(row)
    return run


def _link(table: pa.Table) -> pa.Table:
    """What the chunks want of a block of terms -> its terms and, for each chunk, the positions of what it wants."""
    table = table.sort_by("to")
    wanted = _flat(table["wanted"])
    codes, terms = _codes(wanted.flatten())
    ends = np.cumsum(wanted.value_lengths().to_numpy())
    positions = [_bytes(p, "<u4") for p in np.split(codes, ends[:-1])]
    return pa.table({"block": table["block"][:1], "terms": pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
                     "size": [len(terms)], "to": [table["to"].to_pylist()], "positions": [positions]})


def _messages(chunk: int, cuts: np.ndarray, nw: np.ndarray, nd: np.ndarray, l: float, log_theta: float) -> pd.DataFrame:
    """What a chunk's terms got, by their blocks, and the chunk's own counts."""
    to = [b for b in range(len(cuts) - 1) if cuts[b] < cuts[b + 1]]
    return pd.DataFrame({"block": [*to, -1 - chunk], "chunk": chunk, "f": [*[_bytes(nw[cuts[b]:cuts[b + 1]], "<f8") for b in to], _bytes(nd, "<f8")],
                         "l": [*[0.0] * len(to), l], "log_theta": [*[0.0] * len(to), log_theta]})


def _begin(k: int):
    """The messages of the random start."""
    def run(batches):
        for pdf in batches:
            for chunk, cuts, nd, nw in zip(pdf["chunk"], pdf["cuts"], pdf["nd"], pdf["nw"]):
                yield _messages(chunk, np.frombuffer(cuts, "<u4"), _numbers(nw, k), _numbers(nd, k), 0.0, 0.0)
    return run


def _weights(k: int, eta: float, mass: list[float], vocabulary: int):
    """A block's counts -> P(term | topic) for each chunk, in the order that it keeps its terms."""
    total = np.array([m + vocabulary * (eta - 1) for m in mass])

    def run(batches):
        for pdf in batches:
            for block, f, to, positions in zip(pdf["block"], pdf["f"], pdf["to"], pdf["positions"]):
                phi = (_numbers(f, k) + (eta - 1)) / total
                yield pd.DataFrame({"to": to, "block": block, "f": [phi[np.frombuffer(p, "<u4")].tobytes() for p in positions]})
    return run


def _share_out(k: int, alpha: float):
    """A chunk, its own counts (sent as block -1) and the weights of its terms -> its new counts and its part of the objective."""
    def run(held: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        chunk, runs, places, times, cuts = (held[c].iloc[0] for c in ("chunk", "runs", "places", "times", "cuts"))
        t, cuts = np.frombuffer(places, "<u4"), np.frombuffer(cuts, "<u4")
        n = np.frombuffer(times, "<u1" if len(times) == len(t) else "<f8")
        d = np.repeat(np.arange(len(runs) // 4), np.frombuffer(runs, "<u4"))
        own, *weights = sent.sort_values("block")["f"]
        nd, phi = _numbers(own, k), _numbers(b"".join(weights), k)
        theta = (nd + (alpha - 1)) / (nd.sum(1) + k * (alpha - 1))[:, None]
        new_d, new_t, log = np.zeros(theta.shape), np.zeros(phi.shape), 0.0
        for a in range(0, len(t), EDGES_AT_ONCE):
            b = slice(a, a + EDGES_AT_ONCE)
            first = d[a]
            p = theta[d[b]] * phi[t[b]]
            s = p.sum(1)
            p *= (n[b] / s)[:, None]
            log += float(n[b] @ np.log(s))
            part = _added(d[b] - first, p, 0)
            new_d[first:first + len(part)] += part
            new_t += _added(t[b], p, len(phi))
        return _messages(chunk, cuts, new_t, new_d, log, float(np.log(theta).sum()) if alpha > 1 else 0.0)
    return run


def _add_up(k: int, eta: float):
    """A block of terms and what its terms got in each chunk -> its counts; the own counts of a chunk pass."""
    def run(own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"block": sent["block"], "f": sent["f"], "mass": [[0.0] * k] * len(sent), "log_terms": 0.0,
                                 "l": sent["l"], "log_theta": sent["log_theta"]})
        at = dict(zip(own["to"].iloc[0], own["positions"].iloc[0]))
        nw = np.zeros((int(own["size"].iloc[0]), k))
        sent = sent.sort_values("chunk")
        for chunk, f in zip(sent["chunk"], sent["f"]):
            nw[np.frombuffer(at[chunk], "<u4")] += _numbers(f, k)        # a chunk wants a term once
        return pd.DataFrame({"block": [own["block"].iloc[0]], "f": [nw.tobytes()], "mass": [nw.sum(0)],
                             "log_terms": [float(np.log(nw + (eta - 1)).sum()) if eta > 1 else 0.0], "l": [0.0], "log_theta": [0.0]})
    return run
