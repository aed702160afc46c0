"""Personal data, spelling variants and hard negatives against brute-force
versions, and on odd rows: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns whose names clash with those an operator uses."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyframe.llm import hard_negatives, pii_semicrf, spelling_fm
from skyframe.llm.common import ready

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, spans string, word string, "
          "key string, n string, bucket string, id string, run string, h string")
EXTRA = ("s", "w", "k", "n", "b", "i", "r", "h")


def prose(rng, n):
    parts = ["ka", "lo", "mi", "ren", "tas", "ul", "vor", "eth", "ny", "qua"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(n))


def card(rng, n=16):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(body + d for d in "0123456789" if pii_semicrf.luhn(body + d))


def planted(rng):
    """(form, value) of personal data that the patterns know."""
    return [("email", f"{prose(rng, 1)}.{prose(rng, 1)}{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"),
            ("ip", ".".join(str(rng.randint(10, 255)) for _ in range(4))), ("card", card(rng)),
            ("phone", f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}")]


def texts():
    rng = random.Random(9)
    out = [None, "", " \n", "one", "4", "a@b", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.4", "+1", "+123456789",
           "1" * 5000, "1 2 3 4 5 6 7 8 9 " * 400, "@" * 300, "漢字 1.2.3.4 👍🏽 x@y.zz Ünï"]
    out += [prose(rng, rng.randint(5, 80)) for _ in range(30)]
    for _ in range(40):
        words = prose(rng, 30).split()
        for _, v in planted(rng):
            words.insert(rng.randrange(len(words)), v)
        out.append(" ".join(words))
    out += [f"{prose(rng, 6)} version {rng.randint(1, 9)}.{rng.randint(0, 9)} {prose(rng, 9)}" for _ in range(20)]
    out += [f"{prose(rng, 6)} token = \"{rng.getrandbits(128):032x}\" {prose(rng, 9)}" for _ in range(20)]
    out += [prose(rng, 20_000) + " +49 (030) 555-1234 " + prose(rng, 2000)]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en", ["a", None, "b"][i % 3], len(t or ""), *EXTRA) for i, t in enumerate(texts())]
    return out + [out[40], out[40], (None, out[50][1], None, None, None, *EXTRA), (None, None, None, None, None, *EXTRA)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    ready(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---------------------------------------------------------------- 11
def patterns(text):
    """The contract's spans, written out plainly."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


def test_pattern_spans_and_digest(docs, rows, none):
    got = pii_semicrf.report(docs).collect()
    want = Counter()
    for r in rows:
        spans = patterns(r[1] or "")
        n = Counter(k for k, _, _ in spans)
        want[(r[0], n[0], n[1], n[2], n[3], pii_semicrf.digest(spans))] += 1
    assert Counter(tuple(r[:6]) for r in got) == want
    for r in got:
        spans = [(pii_semicrf.KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert spans == sorted(spans)
    assert pii_semicrf.report(none).collect() == []


def weights_of(seed):
    rng = np.random.default_rng(seed)
    weights, moves = pii_semicrf.empty_weights()
    weights, moves = rng.normal(size=weights.shape), rng.normal(size=moves.shape)
    moves[0, 0] = 0
    return weights, moves


def segmentations(segments, at, end):
    """All ways to cover tokens at..end by single outside tokens and segments."""
    if at == end:
        yield ()
        return
    for rest in segmentations(segments, at + 1, end):
        yield ((at, at + 1, 0, 0.0), *rest)
    for i, j, y, s in segments:
        if i == at:
            for rest in segmentations(segments, j, end):
                yield ((i, j, y, s), *rest)


def total(path, moves):
    state, out = 0, 0.0
    for _, _, y, s in path:
        out, state = out + moves[state, y] + s, y
    return out + moves[state, 0]


@pytest.mark.parametrize("text", ["+49 (30) 555-12 34", "a.b@c.de 1.2.3.4", "x [at] y [dot] zz 12345678", "0049 555 1234 567"])
def test_field_is_exact(text):
    lat = pii_semicrf.Lattice([(text, 0, len(text))])
    for seed in range(4):
        weights, moves = weights_of(seed)
        scores = pii_semicrf.segment_scores(lat, weights)
        segments = [(int(lat.i[s]), int(lat.j[s]), k + 1, scores[s, k]) for s in range(len(lat.i)) for k in range(4)
                    if np.isfinite(scores[s, k])]
        paths = list(segmentations(segments, 0, lat.n))
        best = max(paths, key=lambda p: total(p, moves))
        want = [(0, y - 1, int(lat.start[i]), int(lat.end[j - 1])) for i, j, y, _ in best if y]
        assert pii_semicrf.decode(lat, weights, moves) == want
        gold = {(s, e, k) for _, k, s, e in want}
        fitted = pii_semicrf.Likelihood(lat, [{(k, s, e) for s, e, k in gold}])
        value, grad, change = fitted.value(weights, moves)
        z = np.logaddexp.reduce([total(p, moves) for p in paths])
        assert value == pytest.approx(total(best, moves) - z, abs=1e-6)
        i, k = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        for x, g, at in ((weights, grad, (i, k)), (moves, change, (0, 1)), (moves, change, (2, 0))):
            x[at] += 1e-5
            up = fitted.value(weights, moves)[0]
            x[at] -= 1e-5
            assert (up - value) / 1e-5 == pytest.approx(g[at], abs=1e-3)


def test_other_forms_are_found_and_clean_texts_left_alone(spark, docs):
    rng = random.Random(77)
    model = pii_semicrf.train(docs)
    probes, clean = [], []
    for _ in range(25):
        (_, email), (_, ip), (_, number), (_, phone) = planted(rng)
        for kind, form in ((0, email.replace("@", " [at] ").replace(".example.com", " [dot] example [dot] com")),
                           (1, ip.replace(".", "[.]")), (2, ".".join(number[i:i + 4] for i in range(0, 16, 4))),
                           (3, "00" + phone[1:])):
            lead = prose(rng, 8) + (" " if kind else ", ")
            probes.append((lead + form + " " + prose(rng, 5), kind, len(lead), len(lead) + len(form)))
    clean = [prose(rng, 40) + f" version {rng.randint(1, 9)}.{rng.randint(0, 9)} " + prose(rng, 10) for _ in range(50)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([p[0] for p in probes] + clean)], "i long, text string")
    found = {r["i"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii_semicrf.scan(df, model).collect()}
    exact = sum((k, s, e) in found[i] for i, (_, k, s, e) in enumerate(probes))
    assert exact >= 0.9 * len(probes)
    assert all(not found[i] for i in range(len(probes), len(probes) + len(clean)))


def test_redact_keeps_rows_and_columns(docs, rows, none):
    model = pii_semicrf.train(docs)
    got = pii_semicrf.redact(docs, model)
    assert got.columns == docs.columns and pii_semicrf.redact(none, model).count() == 0
    texts_out = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    for r in rows:
        if r[0] is not None:
            new = texts_out[r[0]]["text"]
            assert (new is None) == (r[1] is None)
            if new is not None:
                assert texts_out[r[0]]["n_chars"] == len(new) and not [s for s in patterns(new) if s[0] != 2]
                if not patterns(r[1]) and "[" not in new:
                    assert new == r[1]


def test_long_surroundings_are_cut_at_line_ends():
    text = "call 555 1234\n" * 5000
    parts = pii_semicrf.regions(text)
    assert parts[0][0] == 0 and parts[-1][1] == len(text) and all(a[1] == b[0] for a, b in itertools.pairwise(parts))
    assert max(b - a for a, b in parts) <= pii_semicrf.LONGEST and all(text[b - 1] == "\n" for _, b in parts)


# ---------------------------------------------------------------- 12
def at_one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_vocabulary(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute_variants(vocabulary):
    near = {w: [v for v in vocabulary if at_one_edit(w, v)] for w in vocabulary}
    form = {}
    for w, vs in near.items():
        top = min(vs, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = top if top and vocabulary[top] >= 2 * vocabulary[w] else None
    out = []
    for w in vocabulary:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, vocabulary[w], len(near[w]), vocabulary[form[w]] if form[w] else None))
    return out


def spelled(rng, n):
    """Texts in which a few words come in many spellings."""
    stems = ["colour", "straße", "vocabulary", "façade", "abcde", "aaaaaa", "été", "naïvely", "ÀÖØöøÿ"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            while rng.random() < 0.35:
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + rng.choice("aeé") + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice("xé") + w[i + 1:]])
            words.append(w.upper() if rng.random() < 0.05 else w)
        out.append(" ".join(words))
    return out


def test_spelling_variants(spark, docs, rows, none):
    rng = random.Random(5)
    more = [(1000 + i, t, None, None, None, *EXTRA) for i, t in enumerate(spelled(rng, 60))]
    more.append((None, more[0][1] + " " + "é" * 3000 + " " + "é" * 3000 + " " + "é" * 3001 + " " + "é" * 3000, None, None, None, *EXTRA))
    df = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    want = brute_variants(brute_vocabulary(rows + more))
    assert sum(x[1] is not None for x in want) > 50
    got = [tuple(r) for r in spelling_fm.group_variants(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert spelling_fm.group_variants(none).count() == 0
    assert spelling_fm.group_variants(docs.select("doc_id", F.lit(None).cast("string").alias("text"))).count() == 0


@pytest.mark.parametrize("most,chars", [(5, 300), (40, 100_000), (10 ** 6, 50)])
def test_large_groups_are_divided(spark, most, chars):
    """Words that share halves, quarters and all but one letter: the same
    pairs, however far groups are divided and indexes filled."""
    rng = random.Random(most)
    vocabulary = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(200)}
    vocabulary |= {"prefixed" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(80)}
    df = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(vocabulary))], "word string, n long")
    got = Counter((r["word"], r["near"]) for r in spelling_fm.near_pairs(df, most=most, index_chars=chars).collect())
    assert got == Counter((a, b) for a in vocabulary for b in vocabulary if at_one_edit(a, b))


def test_suffix_array_and_ranks():
    rng = random.Random(2)
    for n in (1, 2, 30, 300):
        s = "".join(rng.choice("ab") for _ in range(n))
        x = np.array([ord(c) - 96 for c in s] + [0], np.uint8)
        assert spelling_fm.suffix_array(x, 3).tolist() == sorted(range(n + 1), key=lambda i: s[i:])
        ranks = spelling_fm.Ranks(x, 3)
        bwt = [int(x[i - 1]) for i in ranks.order]
        at = np.repeat(np.arange(n + 2), 3)
        c = np.tile(np.arange(3), n + 2)
        same, less = ranks.count(c, at)
        assert same.tolist() == [bwt[:i].count(k) for i, k in zip(at, c)]
        assert less.tolist() == [sum(b < k for b in bwt[:i]) for i, k in zip(at, c)]


# ---------------------------------------------------------------- 13
def brute_negatives(rows, every=50):
    kept = {}
    for i, v, lab in rows:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        lab = int(math.fmod(lab + 1, 10)) if i % 7 == 0 else lab
        kept[i, lab, tuple(math.floor(256 * float(np.float32(x))) for x in v)] = None
    out = Counter()
    for i, lab, v in kept:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in itertools.zip_longest(v, w, fillvalue=0)), j, lj) for j, lj, w in kept if j != i]
        for s, j, _ in sorted(x for x in score if x[2] == lab)[:5]:
            hard = sorted(x for x in score if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            for r, (t, k, _) in enumerate(hard):
                out[i, j, r + 1, k, -s, -t] += 1
    return out


def vectors(rng, n, dims, scale):
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(dims)], rng.randrange(10)) for i in range(n)]
    same = rows[3][1]
    rows += [(n + i, same, rng.randrange(10)) for i in range(n // 3)]
    return rows + [(None, same, 1), (n + 500, None, 1), (n + 501, same, None), (n + 502, [1.0, None], 2), (n + 503, [float("nan")], 2),
                   (n + 504, [float("inf")], 2), (n + 505, [], 3), (n + 550, [0.5], 3), (n + 507, [0.0] * dims, 4), rows[5], rows[50],
                   (-50, same, 3), (-7, same, -1)]


@pytest.mark.parametrize("dims,scale,parts", [(8, 0.2, (4096, 65_536)), (3, 40.0, (2, 50)), (4, 3e6, (3, 64)), (2, 5e6, (4096, 65_536))])
def test_hard_negatives(spark, monkeypatch, dims, scale, parts):
    ready(spark)
    monkeypatch.setattr(hard_negatives, "TILE", parts[0])
    monkeypatch.setattr(hard_negatives, "MAX_BLOCK", parts[1])
    rows = vectors(random.Random(dims), 150, dims, scale)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, label int, id string, h string")
    got = Counter(tuple(r) for r in hard_negatives.mine(df).collect())
    want = brute_negatives(rows)
    assert sum(want.values()) > 10 and got == want
    assert hard_negatives.mine(df.limit(0)).count() == 0


@pytest.mark.parametrize("dims,low,high", [(64, -256, 256), (0, 0, 1), (8, -2 ** 40, 2 ** 40), (4, -2 ** 62, 2 ** 62), (1, 0, 1)])
def test_packed_products(dims, low, high):
    rng = np.random.default_rng(dims)
    a, c = rng.integers(low, high, (70, dims)), rng.integers(low, high, (37, dims))
    want = [[min(max(sum(int(x) * int(y) for x, y in zip(p, q)), -hard_negatives.LONG), hard_negatives.LONG) for q in c] for p in a]
    assert np.concatenate([s for _, s in hard_negatives.products(a, c)]).tolist() == want


def test_neighbours_of_one_index():
    words = ["aaaaa", "aaaab", "aaaaaa", "baaaa", "caaab"]
    asked = pd.DataFrame([(w, 1, len(w), 1, a, b, bar) for w in words for a, b, bar in
                          ((len(w) // 2, 0, 0), (0, len(w) - len(w) // 2, len(w) // 2))], columns="word n m role a b bar".split())
    q, t = spelling_fm.neighbours(words, asked)
    got = Counter((asked["word"][i], words[j]) for i, j in zip(q, t))
    assert got == Counter((a, b) for a in words for b in words if at_one_edit(a, b) and len(b) >= len(a))
