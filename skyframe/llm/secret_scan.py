"""Secret scans: fixed patterns plus sliding-window entropy.

Patterns find assignments (``password = ...``), access keys and long hex
strings.  Beyond them, every candidate string -- a run of 20 or more
characters of the base64 alphabet -- is measured by the Shannon entropy of a
window of ``WINDOW`` characters sliding over it.  The window's character
counts are kept incrementally: one character enters, one leaves, and only
their two terms ``c * log2(c)`` change.  Each character class (hex,
upper-case and digits, all of the alphabet) has its own threshold.  Allow-listed
strings (words, plain numbers, identifiers such as UUIDs, documented
examples, mere repetitions) are suppressed.  What a pattern already covers is
cut out of a candidate, and the pieces left are judged on their own, so a key
next to an access id is found.

Everything is DataFrame functions.  Positions are code points, end
exclusive.  Null text counts as empty; an empty text has no span; texts of
any length are scanned whole; rows are independent, so repeated rows and
ties need no rule; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import text_of

# The patterns of the contract, in listing order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Character classes from narrow to wide: (name, pattern, bits per character)
# that a window must reach.
CLASSES = (("hexdigits", r"^[0-9A-Fa-f]+$", 3.0),
           ("upperdigits", r"^[A-Z0-9]+$", 3.4),
           ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.7))
# Allow list: strings without a digit are words or paths; plain numbers;
# UUIDs; long repetitions of one character; documented example keys.
ALLOWED = (r"^[^0-9]*$", r"^[0-9_=+/-]+$",
           r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
           r"(.)\1{9}", r"(?i:example|sample|placeholder|xxxxxx)")

SPAN = "array<struct<start:long,kind:int,end:long,hit:string>>"


def located(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end, hit).

    The pieces between the matches come from a split by the same pattern, so
    start positions are running sums of lengths.  Texts without a match stop
    at one search."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit(None).cast(SPAN).alias("out"))

    def step(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"),
                        pair["hit"].alias("hit"))
        out = F.concat(F.coalesce(acc["out"], F.array().cast(SPAN)), F.array(span))
        return F.struct(end.cast("long").alias("at"), out.alias("out"))

    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    pairs = F.slice(pairs, 1, F.size(hits))
    found = F.aggregate(pairs, state, step)["out"]
    if keep is not None:
        found = F.filter(found, keep)
    return F.when(F.rlike(text, F.lit(pattern)), F.coalesce(found, F.array().cast(SPAN))).otherwise(
        F.array().cast(SPAN))


def base_spans(text: Column) -> list[Column]:
    long_value = lambda s: F.length(F.regexp_extract(s["hit"], "^" + ASSIGN, 2)) >= 6
    return [located(text, ASSIGN, 0, long_value), located(text, ACCESS, 1), located(text, HEX, 2)]


def peak_entropy(s: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits a character) of any window over ``s``.

    The state holds one count per distinct character and the running sum of
    ``c * log2 c``; each step touches the character that enters and the one
    that leaves.  Strings shorter than the window are measured as one."""
    chars = F.split(s, "")
    alphabet = F.array_distinct(chars)
    w = F.least(F.size(chars), F.lit(window))

    def term(c):
        return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)

    def step(acc, i):
        comes = F.array_position(alphabet, F.element_at(chars, i)).cast("int")
        goes = F.when(i > w, F.array_position(alphabet, F.element_at(chars, F.greatest(i - w, F.lit(1)))).cast("int")) \
            .otherwise(F.lit(0))
        c_in = F.element_at(acc["counts"], comes)
        c_out = F.when(goes > 0, F.element_at(acc["counts"], F.greatest(goes, F.lit(1)))).otherwise(0)
        same = comes == goes
        total = F.when(same, acc["sum"]).otherwise(
            acc["sum"] + term(c_in + 1) - term(c_in)
            + F.when(goes > 0, term(c_out - 1) - term(c_out)).otherwise(0.0))
        counts = F.transform(acc["counts"], lambda c, j: c + F.when(j + 1 == comes, 1).otherwise(0)
                             - F.when(j + 1 == goes, 1).otherwise(0))
        bits = F.when(i >= w, F.log2(w.cast("double")) - total / w).otherwise(0.0)
        return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(acc["best"], bits).alias("best"))

    start = F.struct(F.transform(alphabet, lambda _: F.lit(0)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.lit(0.0).alias("best"))
    return F.when(F.length(s) > 0, F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step)["best"]).otherwise(0.0)


def outside(c: Column, covered: Column) -> Column:
    """The pieces of a candidate between the spans of ``covered`` (ordered by
    start), as spans; pieces below the window's length are no candidates."""
    def piece(at, end):
        return F.struct(at.alias("start"), F.lit(3).alias("kind"), end.alias("end"),
                        F.substring(c["hit"], (at - c["start"] + 1).cast("int"), (end - at).cast("int")).alias("hit"))

    def add(out, at, end):
        return F.when(end - at >= WINDOW, F.concat(out, F.array(piece(at, end)))).otherwise(out)

    def step(acc, b):
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), add(acc["out"], acc["at"], b["start"]).alias("out"))

    start = F.struct(c["start"].alias("at"), F.array().cast(SPAN).alias("out"))
    met = F.filter(covered, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return F.aggregate(met, start, step, lambda acc: add(acc["out"], acc["at"], c["end"]))


def entropy_spans(text: Column, covered: Column) -> Column:
    """Candidates whose entropy reaches their class's threshold, not
    allow-listed.  Spans of ``covered`` are cut out of them first; what is
    left is judged piece by piece."""
    def keep(s):
        hit, free = s["hit"], F.lit(True)
        for a in ALLOWED:
            free = free & ~F.rlike(hit, F.lit(a))
        need = F.lit(CLASSES[-1][2])
        for _, pattern, bits in reversed(CLASSES[:-1]):
            need = F.when(F.rlike(hit, F.lit(pattern)), bits).otherwise(need)
        return F.when(free, peak_entropy(hit) >= need).otherwise(False)

    whole = located(text, CANDIDATE, 3)
    cut_up = F.flatten(F.transform(whole, lambda c: outside(c, covered)))
    return F.when(F.size(covered) > 0, F.filter(cut_up, keep)).otherwise(F.filter(whole, keep))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: ``__base`` and ``__spans``, arrays of
    (start, kind, end, hit) ordered by start, then kind as listed."""
    text = text_of(text_col)
    out = docs.withColumns({"__a": base_spans(text)[0], "__k": base_spans(text)[1], "__h": base_spans(text)[2]})
    out = out.withColumn("__base", F.when(F.size("__a") + F.size("__k") + F.size("__h") > 0,
                                          F.array_sort(F.concat("__a", "__k", "__h")))
                         .otherwise(F.array().cast(SPAN)))
    out = out.withColumn("__e", entropy_spans(text, F.col("__base")))
    out = out.withColumn("__spans", F.when(F.size("__e") > 0, F.array_sort(F.concat("__base", "__e")))
                         .otherwise(F.col("__base")))
    return out.drop("__e")


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts per pattern, digest of the pattern spans, all spans."""
    s = scan(docs.select("doc_id", "text"))
    return s.select("doc_id", F.size("__a").cast("long").alias("n_assign"), F.size("__k").cast("long").alias("n_access"),
                    F.size("__h").cast("long").alias("n_hex"),
                    F.sha2(listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
                    listed(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its text replaced by ``mark`` (overlapping
    spans by one mark); ``n_chars``, where present, is the new length.
    Same columns; null texts stay null; documents without a span are
    unchanged."""
    s = scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text"))
    text = F.col("text")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc, sp):
        fresh = sp["start"] >= acc["at"]
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (sp["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], sp["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("__spans", state, step)
    rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
    hit = F.size("__spans") > 0
    out = s.withColumn("__new", F.when(hit, F.concat(done["out"], rest)).otherwise(text))

    def column(c):
        old = F.col("row").getField(c)
        if c == "n_chars":
            return F.when(hit, F.length("__new").cast(docs.schema[c].dataType)).otherwise(old)
        return F.col("__new") if c == "text" else old

    return out.select(*[column(c).alias(c) for c in docs.columns])
