"""Rows (key, other, value) packed into blocks once, for iterations that send each
round's values of the others to the keys.

A key lives in the block of its hash; its rows lie there as arrays.  The values of a
side's keys are one array per block.  A round sends from every block of the one side
to every block of the other the values that its rows name, as one array in a fixed
order, so rows never move again.  A key with more than ``limit`` rows is hot: its rows
are dealt over all blocks, its results are partial, and as there are at most
rows / limit such keys, their values travel with the task instead.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.session import checkpoint_dir

ROWS_PER_BLOCK = 2_000_000


@dataclass
class Side:
    """One side's rows in blocks: ``blocks`` (block, ids, payload), ``links``
    (block, positions): which of a block's keys each block of the other side names."""
    kind: str
    blocks: DataFrame
    hot: list
    links: DataFrame | None = None
    needs: DataFrame | None = None


def hot_keys(rows: DataFrame, key: str, limit: int) -> list:
    """Keys with more than ``limit`` rows, in order."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return sorted(r[0] for r in n.select(key).collect())               # at most rows / limit


def pack(rows: DataFrame, a: str, b: str, value: str, total: int, rows_per_block: int | None = None) -> tuple[Side, Side]:
    """The two sides of ``rows`` (no key null): keys ``a`` with the others ``b``, and the reverse."""
    count = max(1, -(-total // (rows_per_block or ROWS_PER_BLOCK)))
    limit = max(1, total // count // 4)
    hot = {c: hot_keys(rows, c, limit) for c in (a, b)} if count > 1 else {a: [], b: []}
    base = f"{checkpoint_dir(rows.sparkSession)}/blocks-{uuid.uuid4().hex}"
    sides = [_pack_side(rows, key, other, value, hot, count, f"{base}/{n}") for n, (key, other) in enumerate([(a, b), (b, a)])]
    for n, (side, far) in enumerate([sides, sides[::-1]]):
        side.links = _link(side, far, f"{base}/links{n}")
    return sides[0], sides[1]


def pack_symmetric(rows: DataFrame, a: str, b: str, value: str, total: int, rows_per_block: int | None = None) -> Side:
    """The one side of ``rows`` that name every pair both ways (no key null): what it sends goes to its own blocks."""
    count = max(1, -(-total // (rows_per_block or ROWS_PER_BLOCK)))
    hot = hot_keys(rows, a, max(1, total // count // 4)) if count > 1 else []
    base = f"{checkpoint_dir(rows.sparkSession)}/blocks-{uuid.uuid4().hex}"
    side = _pack_side(rows, a, b, value, {a: hot, b: hot}, count, f"{base}/0")
    side.links = _link(side, side, f"{base}/links0")
    return side


def _home(c: str, count: int):
    return F.pmod(F.xxhash64(F.col(c)), F.lit(count)).cast("int")


def _pack_side(rows: DataFrame, key: str, other: str, value: str, hot: dict, count: int, path: str) -> Side:
    spark = rows.sparkSession
    kinds = dict(rows.dtypes)
    spread = F.pmod(F.xxhash64(key, other), F.lit(count)).cast("int")
    dealt = rows.select(F.when(F.col(key).isin(hot[key]), spread).otherwise(_home(key, count)).alias("block") if hot[key]
                        else _home(key, count).alias("block"),
                        F.col(key).alias("k"), F.col(other).alias("o"), _home(other, count).alias("from"), F.col(value).alias("v"))
    hot_k, hot_o = hot[key], hot[other]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # a block's keys: its own in order, then the hot ones; others: by block and in order, then the hot ones
        k, ids = _places(pdf["k"], np.zeros(len(pdf), int), hot_k, 1)
        o, needed = _places(pdf["o"], pdf["from"].to_numpy(), hot_o, count)
        at = np.argsort(k, kind="stable")
        payload = k[at].astype("<u4").tobytes() + o[at].astype("<u4").tobytes() + pdf["v"].to_numpy(float)[at].astype("<f8").tobytes()
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "ids": [list(ids[0])], "needs": [[list(x) for x in needed]],
                             "payload": [payload]})

    table = f"blocks_{uuid.uuid4().hex}"
    (dealt.groupBy("block").applyInPandas(run, f"block int, ids array<{kinds[key]}>, needs array<array<{kinds[other]}>>, payload binary")
          .write.option("path", path).bucketBy(min(count, 50_000), "block").saveAsTable(table))
    blocks = spark.table(table)
    return Side(kinds[key], blocks.select("block", "ids", "payload"), hot_k,
                needs=blocks.select(F.col("block").alias("to"), F.posexplode("needs").alias("block", "wanted")))


def _places(values: pd.Series, part: np.ndarray, hot: list, parts: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(position of each row's value, the distinct values of each part in order); hot ones come after all others."""
    code, names = pd.factorize(values, sort=True)
    names = np.asarray(names)
    where = np.full(len(names), -1)
    first = np.zeros(len(names), int)
    first[code] = part
    is_hot = np.isin(names, np.asarray(hot, names.dtype)) if hot else np.zeros(len(names), bool)
    cold = np.flatnonzero(~is_hot)
    order = cold[np.argsort(first[cold], kind="stable")]
    where[order] = np.arange(len(order))
    where[is_hot] = len(order) + np.searchsorted(np.asarray(hot), names[is_hot]) if hot else 0
    ends = np.searchsorted(first[order], np.arange(parts + 1))
    return where[code], [names[order[s:e]] for s, e in zip(ends, ends[1:])]


def _link(side: Side, far: Side, path: str) -> DataFrame:
    def run(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"block": [], "to": [], "positions": []})
        ids = np.asarray(own["ids"].iloc[0])
        return pd.DataFrame({"block": own["block"].iloc[0], "to": asked["to"],
                             "positions": [np.searchsorted(ids, np.asarray(w, ids.dtype)).astype("<u4").tobytes() for w in asked["wanted"]]})

    (side.blocks.select("block", "ids").groupBy("block").cogroup(far.needs.filter(F.size("wanted") > 0).groupBy("block"))
         .applyInPandas(run, "block int, to int, positions binary")
         .groupBy("block").agg(F.collect_list(F.struct("to", "positions")).alias("positions")).write.parquet(path))
    return side.blocks.sparkSession.read.parquet(path)


def step(to: Side, source: Side, values: DataFrame, hot_values: np.ndarray, width: int, fn, schema: str) -> DataFrame:
    """One round: ``values`` (block, f: ``width`` numbers for each key of a block) of ``source``,
    and those of its hot keys, go to the blocks of ``to``, where ``fn(block, n, k, o, v, f)``
    gets the number of keys (the last are the hot ones), the rows in order of the key and
    the others' values, and returns one row of ``schema``."""
    hot, n_hot = np.asarray(hot_values, float).reshape(-1, width), len(to.hot)

    def send(batches):
        for pdf in batches:
            for block, f, positions in zip(pdf["block"], pdf["f"], pdf["positions"]):
                f = np.asarray(f, float).reshape(-1, width)
                for p in positions:
                    yield pd.DataFrame({"to": [p["to"]], "source": [block], "f": [f[np.frombuffer(p["positions"], "<u4")].astype("<f8").tobytes()]})

    def receive(own: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        block, n, payload = own["block"].iloc[0], int(own["n"].iloc[0]), own["payload"].iloc[0]
        m = len(payload) // 16
        k, o = (np.frombuffer(payload, "<u4", m, 4 * m * i).astype(np.int64) for i in range(2))
        v = np.frombuffer(payload, "<f8", m, 8 * m)
        parts = [np.frombuffer(f, "<f8").reshape(-1, width) for f in sent.sort_values("source")["f"]]
        return fn(block, n + n_hot, k, o, v, np.concatenate([*parts, hot]))

    messages = values.select("block", "f").join(source.links, "block").mapInPandas(send, "to int, source int, f binary")
    return (to.blocks.select("block", F.size("ids").alias("n"), "payload").groupBy("block")
              .cogroup(messages.groupBy("to")).applyInPandas(receive, schema))
