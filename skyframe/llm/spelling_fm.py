"""Spelling variants by search schemes on bidirectional FM indexes.

The vocabulary is written as one text, ``$word$word$...$``, and indexed in
both directions: a suffix array of the text and one of its mirror image, their
Burrows-Wheeler transforms and rank tables.  A state of a search is the
interval of suffix ranks in each direction; a character can be added at either
end, and the interval on the other side follows from the number of smaller
characters.

One edit leaves one half of a word as it is.  So one search matches the left half
exactly, outwards to the delimiter, then extends to the right across
the other half and its delimiter, allowing one error; the other search does
the same from the right half.  A pair that both would find is left to the
first.  Replacements and insertions are searched for; the pair of a word and a longer
one is reported for both, so deletions need no search.

Distribution.  A word is searched for only among words that share its exact half, so
Spark deals words and queries by (query length, half); many such groups make up
one index of bounded size.  A half that more than ``MOST`` words share
is divided by the same argument: of the rest of the word one half is exact, so
its words are dealt by (half, next quarter) and by (half, last quarter), and so
on until one code point is left, which bounds a group by the square of the alphabet.

Defined results: a null text has no words and a null doc_id counts as empty in the hash; texts
of any length are read whole, repeated rows count each; ties go to the
smaller word in code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import written

# The runs of the contract, after lower-casing of A-Z.
RUN = "[a-zÀ-ÿ]{%d,}"
EVERY, LEAST_LENGTH, LEAST_COUNT, RATIO = 97, 5, 3, 2
MOST = 20_000                   # words of one group; above 92 ** 2, the most that one free code point leaves
INDEX_CHARS = 200_000           # code points of one index
BLOCK, FEW, TILE = 16, 48, 2048


def words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
          every: int = EVERY) -> DataFrame:
    """(word, n): the distinct words of all texts and their occurrences."""
    low = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(low, F.lit(RUN % least_length), F.lit(0))
    each = docs.filter("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % every == 0, less).otherwise(F.col("run"))
    return (each.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= least_length)
                .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


# ---------------------------------------------------------------- the index
def suffix_array(x: np.ndarray, sigma: int) -> np.ndarray:
    """Suffixes of codes ``x`` (0 only at the end) in order, by doubling."""
    n, bits = len(x), max(1, int(sigma - 1).bit_length())
    step = max(1, 62 // bits)
    key, padded = np.zeros(n, np.int64), np.concatenate([x.astype(np.int64), np.zeros(step, np.int64)])
    for i in range(step):
        key = (key << bits) | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable")
        ranked = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        if ranked[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        later = np.zeros(n, np.int64)
        later[:max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + later
        step *= 2


class Ranks:
    """A Burrows-Wheeler transform with counts of smaller characters: exact
    at every ``BLOCK``-th place, the rest counted from the block itself."""

    def __init__(self, x: np.ndarray, sigma: int):
        self.order = suffix_array(x, sigma)
        n = len(x)
        bwt = x[self.order - 1]
        blocks = n // BLOCK + 1
        self.bwt = np.zeros(blocks * BLOCK, x.dtype)
        self.bwt[:n] = bwt
        each = np.bincount(np.arange(n) // BLOCK * sigma + bwt, minlength=blocks * sigma).reshape(blocks, sigma)
        table = np.zeros((blocks, sigma + 1), np.int32)
        table[1:, 1:] = np.cumsum(np.cumsum(each[:-1], axis=0), axis=1)
        self.table, self.rows = table, self.bwt.reshape(blocks, BLOCK)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(x, minlength=sigma))])

    def count(self, c: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first ``i`` characters are ``c``, and are smaller."""
        b, rest = i // BLOCK, i % BLOCK
        row = self.rows[b]
        inside = np.arange(BLOCK) < rest[:, None]
        small = self.table[b, c]
        same = self.table[b, c + 1] - small
        code = c.astype(row.dtype)[:, None]
        return same + ((row == code) & inside).sum(1), small + ((row < code) & inside).sum(1)


class Index:
    """Both directions of a list of words."""

    def __init__(self, texts: list[str]):
        joined = np.frombuffer(("\x01" + "\x01".join(texts) + "\x01").encode("utf-32-le"), np.uint32)
        self.alphabet = np.concatenate([[0], np.unique(joined)])          # end, delimiter, letters
        self.sigma = len(self.alphabet)
        kind = np.uint8 if self.sigma < 256 else np.uint32
        codes = np.searchsorted(self.alphabet, joined).astype(kind)
        end = np.zeros(1, kind)
        self.ahead = Ranks(np.concatenate([codes, end]), self.sigma)
        self.back = Ranks(np.concatenate([codes[::-1], end]), self.sigma)
        lengths = np.array([len(t) for t in texts]) + 1
        self.owner = np.repeat(np.arange(len(texts)), lengths)            # of the delimiter before a word and its letters
        self.size = len(codes) + 1

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words in one array, and where each begins."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, raw)
        known = self.alphabet[np.minimum(at, self.sigma - 1)] == raw
        return np.where(known, at, self.sigma), np.concatenate([[0], np.cumsum([len(w) for w in words])])


def _grow(ranks: Ranks, near: np.ndarray, far: np.ndarray, size: np.ndarray, c: np.ndarray):
    """Add ``c`` at the end whose order ``ranks`` keeps: the new interval
    there (near), on the other side (far), and its size."""
    known = c < len(ranks.first) - 1
    c = np.where(known, c, 0)
    n, k = len(c), np.concatenate([c, c])
    same, small = ranks.count(k, np.concatenate([near, near + size]))
    return (ranks.first[c] + same[:n], far + small[n:] - small[:n], np.where(known, same[n:] - same[:n], 0))


def search(ix: Index, words: list[str], exact: np.ndarray, tail: np.ndarray, mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, text) pairs: texts that begin with the first ``exact`` letters
    of a word and end with its last ``tail``, and differ between by one replaced
    or one more letter.  ``mirrored``: the same from the other end."""
    ahead, back = (ix.back, ix.ahead) if mirrored else (ix.ahead, ix.back)
    codes, begin = ix.encode([w[::-1] for w in words] if mirrored else words)
    length = np.diff(begin)
    letter = lambda q, i: codes[np.minimum(begin[q] + i, len(codes) - 1)]

    # the exact half, from its inner end to the delimiter
    q = np.arange(len(words))
    near, far, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), ix.size)
    step = 0
    stay = [(q[:0], near[:0], far[:0], size[:0])]
    while len(q):
        left = exact[q] - 1 - step
        c = np.where(left >= 0, letter(q, np.maximum(left, 0)), 1)
        near, far, size = _grow(ahead, near, far, size, c)
        live = size > 0
        end = live & (left < 0)
        stay.append((q[end], near[end], far[end], size[end]))
        go = live & (left >= 0)
        q, near, far, size, step = q[go], near[go], far[go], size[go], step + 1
    q, near, far, size = (np.concatenate(x) for x in zip(*stay))

    # across the other half, allowing one error
    at, err = exact[q], np.zeros(len(q), np.int64)
    found_q, found_t = [], []
    while len(q):
        n = length[q]
        over = at > n
        found_q.append(q[over])
        found_t.append(ix.owner[(back if mirrored else ahead).order[(far if mirrored else near)[over]]])
        q, near, far, size, at, err, n = (x[~over] for x in (q, near, far, size, at, err, n))
        stop = n - tail[q]
        free = np.flatnonzero((err == 0) & (at <= stop))
        # one error: every letter that can follow
        few, many = free[size[free] <= FEW], free[size[free] > FEW]
        s = np.repeat(few, size[few])
        inner = np.arange(len(s)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        pairs = np.unique(s * ix.sigma + back.bwt[far[s] + inner])
        s = np.concatenate([pairs // ix.sigma, np.repeat(many, ix.sigma - 2)])
        c = np.concatenate([pairs % ix.sigma, np.tile(np.arange(2, ix.sigma), len(many))])
        own = np.where(at[s] < n[s], letter(q[s], at[s]), 1)
        wanted = (c > 1) & ((c != own) | (at[s] == stop[s]))
        s, c, own = s[wanted], c[wanted], own[wanted]
        f2, n2, z2 = _grow(back, far[s], near[s], size[s], c)
        s, c, own, f2, n2, z2 = (x[z2 > 0] for x in (s, c, own, f2, n2, z2))
        put = (at[s] < stop[s]) & (c != own)                              # may stand for the word's own letter
        # no error: the word's own next letter, or its end
        on = np.flatnonzero((err == 1) | (at < stop))
        f1, n1, z1 = _grow(back, far[on], near[on], size[on], np.where(at[on] < n[on], letter(q[on], at[on]), 1))
        on, f1, n1, z1 = (x[z1 > 0] for x in (on, f1, n1, z1))
        r = s[put]
        q, near, far, size, at, err = (
            np.concatenate([q[on], q[s], q[r]]), np.concatenate([n1, n2, n2[put]]), np.concatenate([f1, f2, f2[put]]),
            np.concatenate([z1, z2, z2[put]]), np.concatenate([at[on] + 1, at[s], at[r] + 1]),
            np.concatenate([err[on], np.ones(len(s) + len(r), np.int64)]))
    return np.concatenate(found_q or [q]), np.concatenate(found_t or [q])


def neighbours(texts: list[str], asked: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``asked``, index of ``texts``) for all queries of an index."""
    ix = Index(texts)
    rows, hits = [], []
    for mirrored, part in ((False, asked[asked["bar"] == 0]), (True, asked[asked["bar"] > 0])):
        first, last = ("b", "a") if mirrored else ("a", "b")
        for i in range(0, len(part), TILE):
            some = part.iloc[i:i + TILE]
            own = some["word"].to_list()
            q, t = search(ix, own, some[first].to_numpy(np.int64), some[last].to_numpy(np.int64), mirrored)
            if mirrored:                     # texts with the same beginning are the other search's
                bar = some["bar"].to_numpy()
                keep = np.array([texts[y][:bar[x]] != own[x][:bar[x]] for x, y in zip(q, t)], bool)
                q, t = q[keep], t[keep]
            rows.append(some.index.to_numpy()[q])
            hits.append(t)
    none = np.zeros(0, np.int64)
    return np.concatenate(rows or [none]), np.concatenate(hits or [none])


def _pairs(pdf: pd.DataFrame) -> pd.DataFrame:
    out = {"word": [], "n": [], "near": [], "near_n": []}
    texts, asked = pdf[pdf["role"] == 0].drop_duplicates("word"), pdf[pdf["role"] == 1].reset_index(drop=True)
    if len(texts) and len(asked):
        listed, counts = texts["word"].to_list(), texts["n"].to_numpy()
        row, hit = neighbours(listed, asked)
        near, near_n = np.array(listed, object)[hit], counts[hit]
        own, own_n = asked["word"].to_numpy(object)[row], asked["n"].to_numpy()[row]
        longer = np.array([len(a) < len(b) for a, b in zip(own, near)], bool)
        out = {"word": np.concatenate([own, near[longer]]), "n": np.concatenate([own_n, near_n[longer]]),
               "near": np.concatenate([near, own[longer]]), "near_n": np.concatenate([near_n, own_n[longer]])}
    if not len(out["word"]):                 # an empty column without a type becomes no Arrow array
        return pd.DataFrame(out).astype({"word": "string", "near": "string"})
    return pd.DataFrame(out)


# ---------------------------------------------------------------- the groups
def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with their group: query length and exact letters."""
    return rows.withColumn("key", F.xxhash64(
        "m", "a", "b", F.substr("word", F.lit(1), F.col("a")),
        F.substr("word", F.length("word") - F.col("b") + 1, F.col("b"))))


def _first_groups(vocabulary: DataFrame, least: int) -> DataFrame:
    """Every word as a query by each half, and as a text for queries of its
    own length and of one less."""
    n = F.length("word")
    part = lambda m, role, a, b, bar: F.struct(
        m.cast("int").alias("m"), F.lit(role).alias("role"), a.cast("int").alias("a"), b.cast("int").alias("b"),
        bar.cast("int").alias("bar"))

    def halves(m, role):
        h, zero = F.floor(m / 2), F.lit(0)
        return [part(m, role, h, zero, zero), part(m, role, zero, m - h, h)]

    own = [*halves(n, 1), *halves(n, 0)]
    shorter = F.when(n > least, F.array(*own, *halves(n - 1, 0))).otherwise(F.array(*own))
    return vocabulary.select("word", "n", F.explode(shorter).alias("g")).select("word", "n", "g.*")


def _divided(rows: DataFrame) -> DataFrame:
    """The rows of groups that are too large, by a further exact part."""
    m, a, b = F.col("m"), F.col("a"), F.col("b")
    free = m - a - b
    half = F.floor(free / 2).cast("int")
    parts = F.array(F.struct((a + half).alias("a"), b.alias("b"), F.col("bar").alias("bar")),
                    F.struct(a.alias("a"), (b + free - half).alias("b"), (a + half).alias("bar")))
    return rows.select("word", "n", "m", "role", F.explode(parts).alias("g")).select("word", "n", "m", "role", "g.*")


def near_pairs(vocabulary: DataFrame, least: int = LEAST_LENGTH, most: int = MOST,
               index_chars: int = INDEX_CHARS) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words at one edit."""
    open_rows, settled = _keyed(_first_groups(vocabulary, least)), []
    while True:
        large = (open_rows.filter("role = 0 and m - a - b > 1").groupBy("key").count()
                          .filter(F.col("count") > most).select("key"))
        large = written(large, "spelling-groups")
        if large.isEmpty():
            break
        settled.append(open_rows.join(large, "key", "left_anti"))
        open_rows = written(_keyed(_divided(open_rows.join(large, "key", "left_semi"))), "spelling-divided")
    rows = open_rows
    for more in settled:
        rows = rows.unionByName(more)
    chars = rows.filter("role = 0").agg(F.sum(F.length("word") + 1)).first()[0] or 0
    buckets = max(1, -(-chars // index_chars))
    return (rows.withColumn("bucket", F.pmod("key", F.lit(buckets))).drop("key").groupBy("bucket")
                .applyInPandas(lambda pdf: _pairs(pdf), "word string, n long, near string, near_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that ``form`` leads to.  Each round every
    word takes its root's root, so rounds are the logarithm of a chain's length."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = written(at.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def group_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, form, form_n, n_near, root of every word of ``docs``."""
    vocabulary = written(words(docs), "spelling-words")
    best = near_pairs(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
    best = best.select("word", "n_near", F.col("top.near").alias("near"), (-F.col("top.minus")).alias("near_n"))
    all_words = vocabulary.join(best, "word", "left")
    leads = F.col("near_n") >= F.lit(ratio) * F.col("n")
    all_words = written(all_words.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, F.col("near")).alias("form"), F.when(leads, F.col("near_n")).alias("form_n")), "spelling-forms")
    last = roots(all_words.filter("form is not null"))
    return (all_words.join(last, "word", "left")
                     .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
