"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target (in words).  A document of a source with target
``t`` and size ``s`` deserves ``t / s`` copies: the whole part is taken as
it is, the fraction is a copy probability.  Two documents with fractional
probabilities ``p`` (size A) and ``q`` (size B) are paired; words are moved
from one to the other -- the sum ``p*A + q*B`` is kept -- until one of the
probabilities is 0 or 1.  The direction is drawn so that every document
keeps its expected number of copies.  The one still fractional meets the
next document.

The pairing runs over a reduction tree: documents of a source fall into
blocks of about ``BLOCK`` by a hash, each block is folded into at most one
residual, ``BLOCK`` residuals form a block of the next level, and so on.
A source with a third of all rows only has more blocks, so no task sees more than
a block at a time.  Blocks are folded from large documents to small ones, so the
residual that is passed on is a small document.  At the root one document is
left; it is rounded by its own probability, so a source's words miss its
target by less than that one document.

Rows alike in id and text are one item: of ``n`` rows with fraction ``p`` the whole part
of ``n * p`` takes a copy each, and one row with the rest as its probability is
paired.  So repeated rows, null ids included, are counted before anything
is gathered.

Defined results: null text or a text without words has size 0 and is never
taken; a null source is a source of its own, last in order; identical rows
are interchangeable; an empty table gives no rows.  All random numbers are
hashes of the rows and ``seed``, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe.llm.common import WORD, cut, text_of, unsigned_unit, written
from skyframe.operators.relational import with_index

BLOCK = 64
CHUNK = 1 << 16


def words_in(col: str = "text") -> Column:
    return F.regexp_count(text_of(col), F.lit(WORD)).cast("long")


def source_targets(per_source: DataFrame, max_repeat: int = 3) -> DataFrame:
    """(source, source_size) -> with weight and target.

    Weights 1, 2, 3, 1, ... by the source's code-point order (null last).
    The targets share the sum of all sizes by weight, none above
    ``max_repeat`` times its source's size; what is cut off is shared again
    among the others until none is above.  One small aggregate a round, over
    one row per source, so any number of sources is fine."""
    ranked = with_index(per_source, [F.col("source").asc_nulls_last()], "ix")
    ranked = cut(ranked.select("source", "source_size", (F.col("ix") % 3 + 1).alias("weight"),
                               (F.col("source_size") * max_repeat).alias("cap")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, share = -1.0, 0.0
    while share > level:                     # the share per unit of weight only grows
        level = share
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        r = ranked.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        if not r[1]:
            break
        share = max(level, (total - (r[0] or 0)) / r[1])
    return ranked.select("source", "source_size", "weight",
                         F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(share)).alias("target"))


def _fold(items: Column, seed: int) -> Column:
    """Fold a block's documents: (the one still fractional, those decided)."""
    def item(x, p):
        return F.struct(x["u"].alias("u"), x["row"].alias("row"), x["size"].alias("size"), p.alias("p"))

    def decided(x, copy):
        return F.struct(x["row"].alias("row"), F.lit(copy).alias("copy"))

    def step(acc, x):
        cur = acc["cur"]
        room_cur, room_x = (F.lit(1.0) - cur["p"]) * cur["size"], (F.lit(1.0) - x["p"]) * x["size"]
        has_cur, has_x = cur["p"] * cur["size"], x["p"] * x["size"]
        up, down = F.least(room_cur, has_x), F.least(has_cur, room_x)
        draw = unsigned_unit(F.xxhash64(cur["u"], x["u"], F.lit(seed)))
        to_cur = draw * (up + down) < down

        def clip(p):
            return F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))

        left = (F.when(to_cur & (room_cur <= has_x), item(x, clip(x["p"] - up / x["size"])))
                 .when(to_cur, item(cur, clip(cur["p"] + up / cur["size"])))
                 .when(has_cur <= room_x, item(x, clip(x["p"] + down / x["size"])))
                 .otherwise(item(cur, clip(cur["p"] - down / cur["size"]))))
        out = (F.when(to_cur & (room_cur <= has_x), decided(cur, 1))
                .when(to_cur, decided(x, 0))
                .when(has_cur <= room_x, decided(cur, 0))
                .otherwise(decided(x, 1)))
        return F.struct(left.alias("cur"), F.concat(acc["done"], F.array(out)).alias("done"))

    first = items[0]
    none = F.slice(F.array(decided(first, 0)), 1, 0)
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))),
                       F.struct(item(first, first["p"]).alias("cur"), none.alias("done")), step)


def pivotal_round(rows: DataFrame, group: str, size: str, prob: str, row: str, order: str,
                  seed: int = 0) -> DataFrame:
    """Round the probabilities ``prob`` (strictly between 0 and 1) of ``rows``
    to 0 or 1 so that each group's sum of ``prob * size`` is kept up to the
    last residual.  ``row`` is carried along, ``order`` is a 64-bit hash of
    the row.  Returns (row, copy)."""
    items = rows.select(F.col(group).alias("g"), F.col(order).alias("u"), F.col(row).alias("row"),
                        F.col(size).cast("double").alias("size"), F.col(prob).alias("p"))
    counts = items.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("long")
    level = (items.join(counts.withColumnRenamed("g", "g2"), F.col("g").eqNullSafe(F.col("g2")))
                  .select("g", F.pmod("u", blocks).alias("b"), "u", "row", "size", "p"))
    width, outs = -(-most // BLOCK), []
    while True:
        block = F.sort_array(F.collect_list(F.struct("size", "u", "p", "row")), asc=False)
        folded = cut(level.groupBy("g", "b").agg(block.alias("items"))
                          .select("g", "b", _fold(F.col("items"), seed).alias("f"))
                          .select("g", "b", "f.cur", "f.done"))
        outs.append(folded.select(F.explode("done").alias("d")).select("d.row", "d.copy"))
        level = folded.select("g", F.floor(F.col("b") / BLOCK).alias("b"), "cur.u", "cur.row", "cur.size", "cur.p")
        if width <= 1:
            break
        width = -(-width // BLOCK)
    last = unsigned_unit(F.xxhash64(F.col("u"), F.lit(seed + 1))) < F.col("p")
    out = level.select("row", F.when(last, 1).otherwise(0).alias("copy"))
    for o in outs:
        out = out.unionByName(o)
    return out


def mix(docs: DataFrame, seed: int = 17, max_repeat: int = 3, carry: list[str] | None = None,
        chunk: int = CHUNK) -> DataFrame:
    """Copies of every document so that each source's words meet its target.

    Returns doc_id, ``carry`` columns, size, source_size, target and copies
    (0 to ``max_repeat``).  Only ids and sizes move; texts are read once."""
    carry = carry or []
    rows = docs.select(F.struct(F.col("doc_id"), *[F.col(c) for c in carry]).alias("row"),
                       F.col("source").cast("string").alias("source"), words_in().alias("size"),
                       F.xxhash64(F.lit(seed), "doc_id", text_of()).alias("u"))
    base = written(rows.groupBy("row", "source", "size", "u").agg(F.count(F.lit(1)).alias("n")), "mix")
    targets = source_targets(base.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = targets.select(F.col("source").alias("s2"), "source_size", "target", rate.alias("rate"))
    # One row per source, broadcast by Spark only below its own size limit;
    # otherwise a sort-merge join whose hot source AQE splits.
    want = F.col("n") * (F.col("rate") - F.floor("rate"))
    rows = (base.join(t, F.col("source").eqNullSafe(F.col("s2")))
                .select("source", "u", "size", (want - F.floor(want)).alias("p"),
                        F.struct("row", "size", "source_size", "target", F.floor("rate").alias("whole"), "n", "u",
                                 F.floor(want).alias("sure")).alias("keep")))
    open_ = (F.col("p") > 0) & (F.col("size") > 0)
    settled = rows.filter(~open_).select(F.col("keep").alias("row"), F.lit(0).alias("copy"))
    rounded = pivotal_round(rows.filter(open_), "source", "size", "p", "keep", "u", seed)
    done = cut(settled.unionByName(rounded).select("row.*", (F.col("row.sure") + F.col("copy")).alias("more")))
    most = done.agg(F.max("n")).first()[0] or 0
    return (each_row(done, most, chunk).select("row.*", "size", "source_size", "target",
                                        F.when(F.col("size") > 0, F.col("whole") + (F.col("i") <= F.col("more")).cast("int"))
                                         .otherwise(0).cast("int").alias("copies")))


def each_row(groups: DataFrame, most: int, chunk: int = CHUNK) -> DataFrame:
    """Every row ``n`` times (at most ``most``), numbered ``i`` from 1.  Groups above ``chunk``
    are cut into chunks that are dealt over tasks by ``u`` and number."""
    one = F.lit(1).cast("long")
    out = groups.filter(F.col("n") <= chunk).withColumn("i", F.explode(F.sequence(one, F.col("n"))))
    if most <= chunk:
        return out
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / chunk))
    large = groups.filter(F.col("n") > chunk).withColumn("c", F.explode(parts)).repartition("u", "c")
    last = F.least(F.col("n"), (F.col("c") + 1) * chunk)
    return out.unionByName(large.withColumn("i", F.explode(F.sequence(F.col("c") * chunk + 1, last))).drop("c"))


def mixed_documents(docs: DataFrame, seed: int = 17, max_repeat: int = 3) -> DataFrame:
    """The mix itself: every row as often as it is taken, rows taken 0 times
    dropped; same columns as ``docs``.  Rows equal in all columns are one
    group whose copies are added up, so they are kept once and repeated by a
    generator, never gathered."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # two hashes, of the columns forwards and backwards: 128 bits name a row
    k, j = F.xxhash64(F.lit(seed), *cols), F.xxhash64(F.lit(seed + 1), *cols[::-1])
    keyed = docs.select(F.struct(*cols).alias("row"), k.alias("k"), j.alias("j"))
    plan = mix(docs.select("doc_id", "text", "source", k.alias("__k"), j.alias("__j")),
               seed, max_repeat, carry=["__k", "__j"])
    plan = cut(plan.filter("copies > 0").groupBy(F.col("__k").alias("k"), F.col("__j").alias("j"))
                   .agg(F.sum("copies").alias("n")))
    most = plan.agg(F.max("n")).first()[0] or 0
    once = keyed.groupBy("k", "j").agg(F.first("row").alias("row"))
    return each_row(once.join(plan, ["k", "j"]).select("row", "n", F.col("k").alias("u")), most).select("row.*")
