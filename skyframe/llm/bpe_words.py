"""Byte-level BPE over a distinct-word table.

Encoding takes three steps.  (1) Every task splits its texts into words and
numbers the distinct words of a chunk of texts by falling frequency; the chunk keeps its
documents as arrays of these numbers, i.e. by position.  (2) The chunks' words are
exchanged by a hash of the word, so equal words of all chunks meet in one bucket and each
distinct word is encoded once.  (3) The ids come back to the chunk, and the position
arrays turn into token ids.  What moves is each chunk's distinct words and
their ids, packed and compressed per (chunk, bucket), not the texts; the documents' arrays
wait in a table bucketed by chunk.  A frequent word is one entry per chunk, so no
bucket grows hot, and the number of buckets follows the bytes of text.

Words are cut where no token can span: a word is an optional space and a run
of non-spaces, or a run of white space less the space that belongs to the next word.  A text
that holds an added token's string or one of the control characters U+001C to
U+001F, about which definitions of white space differ, is taken as a single word.

Decoding maps ids to byte pieces through the vocabulary's id-to-piece table
(its size is fixed by the tokenizer file, so it is broadcast) and joins them.
Where ids and their decoded text are wanted at once, as by ``digests``, pieces are
joined once per distinct word of a chunk.

Defined results: null and empty texts have no ids and decode to the empty
string; texts are read whole, a text longer than a chunk is a chunk of its own; rows
are independent, so repeated rows, ids and null ids stay as they are; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.llm.common import text_of
from skyframe.session import checkpoint_dir

CHUNK_CHARS = 10_000_000
BUCKET_BYTES = 8_000_000
WORDS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
UNSURE = re.compile("[\x1c-\x1f]")
CHUNKS = "chunk long, bucket int, payload binary"


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file, read by the driver: executors need not have it."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


# ---------------------------------------------------------------- packing
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers as one compressed value."""
    import zstandard
    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
    raw = len(head).to_bytes(4, "little") + head + b"".join(a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, n in json.loads(raw[4:at]):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out


def smallest(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def planes(a: np.ndarray) -> list[np.ndarray]:
    """Numbers below 2^32 as their low, second, ... bytes, as many as needed."""
    top = int(a.max()) if len(a) else 0
    return [(a >> 8 * i & 255).astype(np.uint8) for i in range(max(1, -(-top.bit_length() // 8)))]


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return sum(p.astype(np.int64) << 8 * i for i, p in enumerate(parts))


# ---------------------------------------------------------------- splitting
def split_words(text: str, added: list[str]) -> list[str]:
    if UNSURE.search(text) or any(a in text for a in added):
        return [text]
    return WORDS.findall(text)


def _splitter(buckets: int, added: list[str], chunk_chars: int):
    """Partition of (doc_id, text) -> packed chunks.  Bucket -1 holds the
    documents: their ids and, by position, the numbers of their words.  Texts
    become Python strings one at a time, never a whole batch of them."""
    def rows(chunk, ids, docs, words):
        flat = np.concatenate(docs)
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        names = list(words)
        raw = [names[i].encode("utf-8", "replace") for i in order.tolist()]
        home = np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)) % np.uint32(buckets)
        null = np.array([i is None for i in ids], np.uint8)
        value = np.array([0 if i is None else i for i in ids], np.int64)
        counts = np.array([len(d) for d in docs], np.uint32)
        out = [(chunk, -1, pack(value, null, counts, smallest(home), *planes(number[flat])))]
        by_home = np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.diff(home[by_home].astype(np.int64), prepend=-1, append=-1)) if len(raw) else []
        for a, b in zip(edges[:-1], edges[1:]):
            part = [raw[i] for i in by_home[a:b].tolist()]
            out.append((chunk, int(home[by_home[a]]), pack(smallest(np.array([len(r) for r in part])),
                                                           np.frombuffer(b"".join(part), np.uint8))))
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in
                                           zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))],
                                          names=["chunk", "bucket", "payload"])

    def run(batches):
        from pyspark import TaskContext
        chunk = TaskContext.get().partitionId() << 32
        ids, docs, words, size = [], [], {}, 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = t.as_py()
                if ids and size + len(t) > chunk_chars:
                    yield rows(chunk, ids, docs, words)
                    chunk, ids, docs, words, size = chunk + 1, [], [], {}, 0
                size += len(t)
                ids.append(i)
                found = split_words(t, added)
                for w in found:
                    if w not in words:
                        words[w] = len(words)
                docs.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
        if ids:
            yield rows(chunk, ids, docs, words)
    return run


# ---------------------------------------------------------------- encoding
def _load(source: str):
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(source)
    tok.no_truncation()
    tok.no_padding()
    return tok


def encode_words(tok, words: list[str], length: np.ndarray) -> list[np.ndarray]:
    """Ids of each word.  Plain words (a space, then no other space) are
    encoded many to a call -- no token spans them -- and taken apart by the
    byte lengths of the ids (``length``)."""
    out: list = [None] * len(words)
    plain = [i for i, w in enumerate(words) if len(w) > 1 and w[0] == " " and len(w.split()) == 1
             and not w[1].isspace() and not w[-1].isspace()]
    groups = [plain[a:a + 400] for a in range(0, len(plain), 400)]
    for some in range(0, len(groups), 50):
        part = groups[some:some + 50]
        for g, e in zip(part, tok.encode_batch_fast(["".join(words[i] for i in g) for g in part],
                                                    add_special_tokens=False)):
            ids = np.array(e.ids, np.int64)
            ends = np.cumsum(length[ids])
            want = np.cumsum([len(words[i].encode()) for i in g])
            at = np.searchsorted(ends, want)
            if len(ends) and at[-1] < len(ends) and (ends[at] == want).all():
                for i, piece in zip(g, np.split(ids, at[:-1] + 1)):
                    out[i] = piece
    for i, w in enumerate(words):
        if out[i] is None:
            out[i] = np.array(tok.encode(w, add_special_tokens=False).ids, np.int64)
    return out


def _bucket_encoder(source):
    """All chunks' words of one bucket -> their ids, each word encoded once."""
    made: list = []

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(_load(source.value))
            made.append(np.array([len(p) for p in pieces_of(source.value)], np.int64))
        number: dict[bytes, int] = {}
        uses = []
        for payload in pdf["payload"]:
            lengths, raw = unpack(payload)
            data, ends = raw.tobytes(), np.cumsum(lengths, dtype=np.int64).tolist()
            uses.append(np.array([number.setdefault(data[a:b], len(number)) for a, b in zip([0, *ends[:-1]], ends)],
                                 np.int64))
        ids = encode_words(made[0], [w.decode("utf-8", "replace") for w in number], made[1])
        counts = np.array([len(i) for i in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        payloads = []
        for u in uses:
            payloads.append(pack(smallest(counts[u]), smallest(flat[ranges(counts, u)])))
        return pd.DataFrame({"chunk": pdf["chunk"], "bucket": pdf["bucket"], "payload": payloads})
    return run


def ranges(counts: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Positions of the runs ``use`` in a flat array of runs of ``counts``."""
    starts, n = np.cumsum(counts) - counts, counts[use]
    total = np.concatenate(([0], np.cumsum(n)))
    return np.repeat(starts[use] - total[:-1], n) + np.arange(total[-1])


def _chunk_documents(docs: pd.DataFrame, words: pd.DataFrame):
    """A chunk's documents and its words' ids: per word (in the chunk's
    numbering) the number of ids, all ids in that order, and for each document its id
    and word numbers."""
    parts = [unpack(p) for p in words.sort_values("bucket")["payload"]]
    counts = np.concatenate([p[0] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
    flat = np.concatenate([p[1].astype(np.int32) for p in parts]) if parts else np.zeros(0, np.int32)
    value, null, n, home, *use = unpack(docs["payload"].iloc[0])
    place = np.empty(len(home), np.int64)    # the words came back by bucket
    place[np.argsort(home, kind="stable")] = np.arange(len(home))
    counts, flat = counts[place], flat[ranges(counts, place)]
    use, ends = joined(use), np.cumsum(n, dtype=np.int64)
    each = [(None if gone else i, use[a:b]) for i, gone, a, b in
            zip(value.tolist(), null.tolist(), (ends - n).tolist(), ends.tolist())]
    return counts, flat, each


def _ids(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
    counts, flat, each = _chunk_documents(docs, words)
    starts, out = np.cumsum(counts) - counts, []
    for _, use in each:
        n = counts[use]
        total = np.cumsum(n)
        out.append(flat[np.repeat(starts[use] - total + n, n) + np.arange(total[-1] if len(n) else 0)])
    return pd.DataFrame({"doc_id": pd.array([i for i, _ in each], dtype="Int64"), "ids": pd.Series(out, dtype=object)})


def _digests(source):
    """Digests of each document's ids and of the text they decode to."""
    made: list = []

    def run(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if not made:
            made.append(pieces_of(source.value))
        counts, flat, each = _chunk_documents(docs, words)
        ends = np.cumsum(counts).tolist()
        runs = [flat[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
        listed, text = [",".join(map(str, r)) for r in runs], [b"".join(map(made[0].__getitem__, r)) for r in runs]
        out = []
        for i, use in each:
            use_ = use.tolist()
            decoded = b"".join(map(text.__getitem__, use_)).decode("utf-8", "replace")
            out.append((i, int(counts[use].sum()), hashlib.sha256(",".join(map(listed.__getitem__, use_)).encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame({"doc_id": pd.array([o[0] for o in out], dtype="Int64"),
                             **{c: pd.Series([o[k] for o in out], dtype=kind) for k, c, kind in (
                                 (1, "n_tokens", "int64"), (2, "ids_sha256", object), (3, "decoded_sha256", object))}})
    return run


def _through_words(docs: DataFrame, source: str, finish, schema: str, chunk_chars: int, bucket_bytes: int) -> DataFrame:
    """Steps (1) to (3); ``finish`` gets a chunk's documents and words."""
    spark = docs.sparkSession
    added = [a["content"] for a in json.loads(source).get("added_tokens", [])]
    shared = spark.sparkContext.broadcast(source)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    (docs.mapInArrow(_splitter(buckets, added, chunk_chars), CHUNKS).write
         .option("path", f"{checkpoint_dir(spark)}/{name}").option("compression", "none")      # packed already
         .bucketBy(int(min(50_000, max(1, -(-total // 16_000_000)))), "chunk").saveAsTable(name))
    chunks = spark.table(name)
    ids = chunks.filter("bucket >= 0").groupBy("bucket").applyInPandas(_bucket_encoder(shared), CHUNKS)
    return (chunks.filter("bucket < 0").groupBy("chunk").cogroup(ids.groupBy("chunk"))
                  .applyInPandas(finish(shared), schema))


def encode(docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids)."""
    return _through_words(docs, tokenizer_json(path), lambda _: _ids, "doc_id long, ids array<int>",
                          chunk_chars, bucket_bytes)


# ---------------------------------------------------------------- decoding
def pieces_of(source: str) -> list[bytes]:
    """Byte piece of every id.  The vocabulary spells bytes as characters:
    visible Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from U+0100 on (fixed values of the format)."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(other)}
    spec = json.loads(source)
    vocab = spec["model"]["vocab"]
    added = {a["id"]: a["content"].encode() for a in spec.get("added_tokens", [])}
    out = [b""] * (max([*vocab.values(), *added]) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(byte[c] for c in piece)
    for i, content in added.items():
        out[i] = content
    return out


def decode(spark: SparkSession, ids: Column, path: str | None = None) -> Column:
    """Text of an array of ids; bytes that are not UTF-8 become U+FFFD."""
    shared = spark.sparkContext.broadcast(pieces_of(tokenizer_json(path)))

    @F.pandas_udf("string")
    def one(batch: pd.Series) -> pd.Series:
        piece = shared.value.__getitem__
        return pd.Series([b"".join(map(piece, i.tolist())).decode("utf-8", "replace") if i is not None else None
                          for i in batch], dtype=object)
    return one(ids)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    return _through_words(docs, tokenizer_json(path), _digests,
                          "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", CHUNK_CHARS, BUCKET_BYTES)
