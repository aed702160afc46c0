"""Removal of repeated byte strings by a sampled suffix comparison.

Every byte covered by a string of ``LENGTH`` bytes that starts at two or more
places of the corpus is removed.  Two suffixes that share ``LENGTH`` bytes are
found through sampled positions, as a difference cover does it: the
sample is chosen so that two equal strings have a sampled position at the same
offset.  The steps:

1. *Sample.*  In every string of ``LENGTH`` bytes the position whose 32-byte piece
   hashes lowest (the leftmost of equals) is sampled: the choice depends on the string's
   own bytes only, so equal strings sample the same offset.  About one position in 85 is sampled.
2. *Sort sampled triples, name them.*  A sampled position is the triple of
   (bytes before, piece, bytes after) over all strings that sampled it.  The
   pieces, and the whole triples, are exchanged by range of their name and sorted; equal neighbours
   give each its multiplicity.
3. *Recurse on names.*  A piece that occurs once has no repeated string around it; a triple that
   occurs twice repeats in all its strings.  Only pieces that occur in different triples go on,
   each triple once.
4. *Merge the remaining suffixes.*  The strings of these triples, one per
   unsampled position, are named by 96 bits over all ``LENGTH`` bytes, exchanged by
   range and sorted with each other.
5. *Compare adjacent prefixes.*  Equal neighbours in that order repeat.  The answers go
   back to the texts as one bit per name.

Names are exchanged as packed sorted arrays per (chunk, range), each distinct name once
per chunk: a passage in a third of all documents is one entry per chunk.  The
texts themselves move only once, into a table bucketed by chunk in the
shared folder, which all passes read without another exchange.

Defined results: null text counts as empty; texts under ``LENGTH`` bytes lose nothing;
matches never cross documents; overlaps and repeats inside one document count;
repeated rows are documents like any other; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.bpe_words import pack, unpack
from skyframe.llm.common import text_of, written
from skyframe.session import checkpoint_dir

LENGTH, PIECE = 200, 32
BLOCK_BYTES, CHUNK_BYTES, RANGE_BYTES, BUCKET_BYTES = 1_000_000, 8_000_000, 24_000_000, 16_000_000
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)
PIECES, TRIPLES, STRINGS = 0, 1, 2
MESSAGE = "chunk long, kind int, home int, payload binary"


# ---------------------------------------------------------------- hashing
def scramble(h: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers that spreads every bit (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


POWERS: dict = {}                            # tables of this Python worker


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random number per byte value; powers of an odd base and of its inverse."""
    if (seed, n) in POWERS:
        return POWERS[seed, n]
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 1 << 64, 256, dtype=np.uint64)
    base = int(rng.integers(1, 1 << 62, dtype=np.uint64)) * 8 + 5 & (1 << 64) - 1
    inverse = pow(base, -1, 1 << 64)
    out = [values]
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    POWERS[seed, n] = tuple(out)
    return POWERS[seed, n]


class Prefixes:
    """Hash of any stretch of a buffer from prefix sums."""

    def __init__(self, buf: np.ndarray, seed: int):
        size = 1 << max(20, len(buf).bit_length())
        values, power, self.inverse = _powers(seed, size)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(values[buf] * power[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.inverse[start])

    def pieces(self, n: int) -> np.ndarray:
        m = len(self.sums) - n
        return scramble((self.sums[n:] - self.sums[:m]) * self.inverse[:m])


def sampled(buf: np.ndarray, ends: np.ndarray, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled positions of the documents that end at ``ends``: (position,
    first string, last string, name of the piece)."""
    n = len(buf) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    piece, width = prefixes.pieces(PIECE), LENGTH - PIECE + 1
    place = np.empty(n, np.int64)
    step = 1 << PLACE_BITS - 1
    for s in range(0, n, step):              # places within a step fit the low bits
        count = min(step, n - s)
        low = (piece[s:s + count + width - 1] & ~PLACE) | np.arange(count + width - 1, dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        low = np.minimum(low[:count], low[width - reach:width - reach + count])
        place[s:s + count] = (low & PLACE).astype(np.int64) + s
    starts = np.concatenate(([0], ends[:-1]))
    out = np.zeros(len(buf) + 1, np.int32)   # strings that would cross a document's end
    np.add.at(out, np.maximum(starts, ends - LENGTH + 1), 1)
    np.add.at(out, ends, -1)
    inside = np.flatnonzero(np.cumsum(out)[:n] == 0)
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = place[inside]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1))))
    last = np.concatenate((inside[new[1:] - 1], inside[-1:]))
    return at[new], inside[new], last, piece[at[new]]


class Names:
    """Distinct 96-bit names in order, with a flag each; remembers which
    occurrence has which name."""

    def __init__(self, high: np.ndarray, low: np.ndarray, flag: np.ndarray):
        order = np.lexsort((low, high))
        h, lo = high[order], low[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])))[:len(h)]
        at = np.flatnonzero(new)
        self.high, self.low = h[at], lo[at]
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.first = np.zeros(len(h), bool)  # one occurrence stands for all of its name
        self.first[order[at]] = True
        n = np.diff(np.append(at, len(h)))
        self.flag = (n > 1) | (np.maximum.reduceat(flag[order], at) if len(at) else np.zeros(0, bool))

    def messages(self, chunk: int, kind: int, homes: int) -> list:
        """The names by range, as sorted differences in byte planes."""
        home = range_of(self.high, homes)
        edges = np.flatnonzero(np.diff(home, prepend=-1, append=homes))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            planes = np.diff(self.high[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
            out.append((chunk, kind, int(home[a]), pack(np.ascontiguousarray(planes).ravel(), self.low[a:b],
                                                        np.packbits(self.flag[a:b]))))
        return out


def range_of(high: np.ndarray, homes: int) -> np.ndarray:
    return ((high >> np.uint64(32)) * np.uint64(homes) >> np.uint64(32)).astype(np.int64)


def unpack_names(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes, low, flag = unpack(payload)
    n = len(low)
    high = np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)
    return high, low, np.unpackbits(flag, count=n).astype(bool)


# ---------------------------------------------------------------- chunks
class Chunk:
    """The documents of a chunk, its sampled positions and their names."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("seq")
        self.number = int(rows["chunk"].iloc[0])
        self.blocks = [(np.frombuffer(t, np.uint8), unpack(h)) for t, h in zip(rows["text"], rows["head"])]
        found, pieces, triples, more = [], [], [], []
        for b, (buf, (_, _, lengths)) in enumerate(self.blocks):
            one, two = Prefixes(buf, 1), Prefixes(buf, 2)
            at, first, last, piece = sampled(buf, np.cumsum(lengths, dtype=np.int64), one)
            shape = scramble(((at - first) * 1024 + (last - first)).astype(np.uint64))
            found.append(np.stack([np.full(len(at), b), first, last]))
            pieces.append(piece)
            triples.append(scramble(one.of(first, last + LENGTH) ^ shape))
            more.append((two.of(first, last + LENGTH) >> np.uint64(32)).astype(np.uint32))
        self.block, self.first, self.last = np.concatenate(found, axis=1)
        piece, triple, more = np.concatenate(pieces), np.concatenate(triples), np.concatenate(more)
        self.triples = Names(triple, more, np.zeros(len(triple), bool))
        # A piece's name is its hash and, in the low part, one of its triples: pieces
        # with one name here and there have one triple only if that is equal everywhere.
        order = np.lexsort((triple, piece))
        p, t = piece[order], triple[order]
        at = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1]))[:len(p)])
        self.piece, self.least = p[at], (t[at] if len(at) else t)
        self.piece_of = np.empty(len(p), np.int64)
        self.piece_of[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(p))))
        self.many = np.diff(np.append(at, len(p))) > 1
        self.mixed = (np.maximum.reduceat(t, at) != self.least) if len(at) else np.zeros(0, bool)

    def name_messages(self, homes: int) -> pd.DataFrame:
        out = self.triples.messages(self.number, TRIPLES, homes)
        home = range_of(self.piece, homes)
        edges = np.flatnonzero(np.diff(home, prepend=-1, append=homes))
        for a, b in zip(edges[:-1], edges[1:]):
            planes = np.diff(self.piece[a:b], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
            out.append((self.number, PIECES, int(home[a]), pack(
                np.ascontiguousarray(planes).ravel(), self.least[a:b], np.packbits(self.many[a:b]),
                np.packbits(self.mixed[a:b]))))
        return pd.DataFrame(out, columns=["chunk", "kind", "home", "payload"])

    def learn(self, replies: pd.DataFrame) -> None:
        """From the answers on pieces and triples: which strings repeat for sure, and
        which are still to be named."""
        piece, triple = answer(replies, PIECES, len(self.piece)), answer(replies, TRIPLES, len(self.triples.high))
        mixed = piece[self.piece_of] == 2
        repeats, stands = (triple[self.triples.of] & 1) > 0, (triple[self.triples.of] & 2) > 0
        self.sure = repeats
        self.open = mixed & (~repeats | (stands & self.triples.first))
        where, high, low = [], [], []
        for b, (buf, _) in enumerate(self.blocks):
            todo = np.flatnonzero(self.open & (self.block == b))
            if not len(todo):
                continue
            n = self.last[todo] - self.first[todo] + 1
            total = np.concatenate(([0], np.cumsum(n)))
            start = np.repeat(self.first[todo] - total[:-1], n) + np.arange(total[-1])
            high.append(Prefixes(buf, 1).of(start, start + LENGTH))
            low.append((Prefixes(buf, 2).of(start, start + LENGTH) >> np.uint64(32)).astype(np.uint32))
            where.append(np.stack([np.full(len(start), b), start, np.repeat(todo, n)]))
        self.where = np.concatenate(where, axis=1) if where else np.zeros((3, 0), np.int64)
        self.strings = Names(np.concatenate(high) if high else np.zeros(0, np.uint64),
                             np.concatenate(low) if low else np.zeros(0, np.uint32), self.sure[self.where[2]])

    def covered(self, replies: pd.DataFrame) -> list[np.ndarray]:
        """Per block: which bytes go."""
        repeated = answer(replies, STRINGS, len(self.strings.high))[self.strings.of] > 0
        out = []
        for b, (buf, _) in enumerate(self.blocks):
            edge = np.zeros(len(buf) + 1, np.int32)
            sure = np.flatnonzero(self.sure & (self.block == b))
            np.add.at(edge, self.first[sure], 1)
            np.add.at(edge, self.last[sure] + LENGTH, -1)
            start = self.where[1, (self.where[0] == b) & repeated]
            np.add.at(edge, start, 1)
            np.add.at(edge, start + LENGTH, -1)
            out.append(np.cumsum(edge)[:-1] > 0)
        return out


def answer(replies: pd.DataFrame, kind: int, n: int) -> np.ndarray:
    mine = replies[replies["kind"] == kind].sort_values("home")
    parts = [unpack(p)[0] for p in mine["payload"]]
    out = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    assert len(out) == n, (kind, len(out), n)
    return out


def _answers(rows: pd.DataFrame) -> pd.DataFrame:
    """All names of one range, from all chunks, sorted; equal neighbours decide.

    Pieces: 0 occurs once, 1 more often in one triple, 2 in several triples.
    Triples: bit 0 repeats, bit 1 stands for its equals.  Strings: repeats."""
    rows = rows.sort_values("chunk", kind="stable")
    kind = int(rows["kind"].iloc[0])
    if kind == PIECES:
        parts = []
        for payload in rows["payload"]:
            planes, least, many, mixed = unpack(payload)
            n = len(least)
            high = np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)
            parts.append((high, least, np.unpackbits(many, count=n) + 2 * np.unpackbits(mixed, count=n)))
    else:
        parts = [unpack_names(p) for p in rows["payload"]]
    high, low, flag = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(high, kind="stable") if kind == PIECES else np.lexsort((low, high))
    h, lo, f = high[order], low[order], flag[order]
    same = h[1:] == h[:-1]
    if kind != PIECES:
        same = same & (lo[1:] == lo[:-1])
    at = np.flatnonzero(np.concatenate(([True], ~same)))
    n = np.diff(np.append(at, len(h)))
    if kind == PIECES:
        shared = (n > 1) | (np.bitwise_or.reduceat(f, at) & 1 > 0)
        mixed = (np.bitwise_or.reduceat(f, at) & 2 > 0) | (np.minimum.reduceat(lo, at) != np.maximum.reduceat(lo, at))
        verdict = np.repeat(shared.astype(np.uint8) + (shared & mixed), n)
    else:
        verdict = np.repeat(((n > 1) | np.logical_or.reduceat(f, at)).astype(np.uint8), n)
        if kind == TRIPLES:
            verdict[at] |= 2
    back = np.empty(len(h), np.uint8)
    back[order] = verdict
    sizes = np.cumsum([len(p[0]) for p in parts])[:-1]
    return pd.DataFrame({"chunk": rows["chunk"], "kind": rows["kind"], "home": rows["home"],
                         "payload": [pack(p) for p in np.split(back, sizes)]})


# ---------------------------------------------------------------- jobs
def _blocks(batches):
    """(doc_id, text) -> blocks of whole texts; blocks make up chunks."""
    from pyspark import TaskContext
    base, chunk, seq, size, filled = TaskContext.get().partitionId() << 32, 0, 0, 0, 0
    ids, texts = [], []

    def row():
        head = pack(np.array([0 if i is None else i for i in ids], np.int64),
                    np.array([i is None for i in ids], np.uint8), np.array([len(t) for t in texts], np.uint32))
        return pd.DataFrame({"chunk": [base + chunk], "seq": [seq], "head": [head], "text": [b"".join(texts)]})

    for pdf in batches:
        for i, t in zip(pdf["doc_id"].astype(object), pdf["text"]):
            t = bytes(t)
            if ids and size + len(t) > BLOCK_BYTES:
                yield row()
                filled, seq, size, ids, texts = filled + size, seq + 1, 0, [], []
                if filled >= CHUNK_BYTES:
                    chunk, seq, filled = chunk + 1, 0, 0
            ids.append(None if pd.isna(i) else int(i))
            texts.append(t)
            size += len(t)
    if ids:
        yield row()


def bucketed(docs: DataFrame, total: int) -> DataFrame:
    """The texts in blocks, as a table bucketed by chunk in the shared folder."""
    spark = docs.sparkSession
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    (docs.mapInPandas(_blocks, "chunk long, seq int, head binary, text binary").write
         .option("path", f"{checkpoint_dir(spark)}/{name}").option("compression", "zstd")
         .bucketBy(int(min(50_000, max(1, -(-total // BUCKET_BYTES)))), "chunk").saveAsTable(name))
    return spark.table(name)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs, start and end in bytes) and kept
    (the remaining bytes) of every document."""
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    homes = int(max(1, -(-total // RANGE_BYTES)))
    blocks = bucketed(docs, total)
    sent = blocks.groupBy("chunk").applyInPandas(lambda rows: Chunk(rows).name_messages(homes), MESSAGE)
    names = written(sent.groupBy("kind", "home").applyInPandas(_answers, MESSAGE), "suffix-names")

    def strings(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(rows)
        chunk.learn(replies)
        return pd.DataFrame(chunk.strings.messages(chunk.number, STRINGS, homes),
                            columns=["chunk", "kind", "home", "payload"])

    def results(rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        chunk, out = Chunk(rows), []
        chunk.learn(replies)
        for (buf, (ids, null, lengths)), gone in zip(chunk.blocks, chunk.covered(replies)):
            ends = np.cumsum(lengths, dtype=np.int64)
            for i, no, a, b in zip(ids.tolist(), null.tolist(), (ends - lengths).tolist(), ends.tolist()):
                edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
                out.append((None if no else i, b - a, [{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()],
                            buf[a:b][~gone[a:b]].tobytes()))
        done = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
        return done.astype({"doc_id": "Int64"})

    known = blocks.groupBy("chunk").cogroup(names.groupBy("chunk")).applyInPandas(strings, MESSAGE)
    last = written(known.groupBy("kind", "home").applyInPandas(_answers, MESSAGE), "suffix-strings")
    return (blocks.groupBy("chunk").cogroup(names.unionByName(last).groupBy("chunk"))
                  .applyInPandas(results, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is kept."""
    r = remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return r.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))
