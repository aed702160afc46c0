"""Naive Bayes on long tables (document, term, count): multinomial and
Bernoulli, with additive smoothing.

The model is one aggregate, the counts of every (term, class); scoring is a
join of the documents' terms with the model's term rows, so neither vocabulary nor
documents are ever collected.  A term that most documents hold is looked up
by ``keyed_join`` and stays spread.  Only the list of classes, with two
numbers each, is on the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.plans.joins import keyed_join
from skyframe.session import checkpoint_dir


@dataclass
class NaiveBayes:
    """``weights``: (term, w), one weight per class in the order of
    ``classes``; the score of a class is
    prior + sum over the document's terms of n * (base + w)."""
    kind: str
    classes: list
    prior: list[float]
    base: list[float]
    weights: DataFrame

    def scores(self, terms: DataFrame, doc: str = "doc_id", term: str = "term", n: str = "n") -> DataFrame:
        """(doc, prediction, score): the class of largest score, the
        smallest one among equals.  Terms that training never saw are left out;
        a document without any other gets its prior."""
        count = F.lit(1.0) if self.kind == "bernoulli" else F.col(n).cast("double")
        rows = terms.select(F.col(doc).alias("doc"), F.col(term).alias("term"), count.alias("n"))
        checkpoint_dir(rows.sparkSession)
        rows = rows.checkpoint(eager=True)
        found = keyed_join(rows, self.weights, "term", rows.count(), "left")
        known = F.when(F.col("w").isNotNull(), F.col("n")).otherwise(0.0)
        sums = found.groupBy("doc").agg(F.sum(known).alias("m"), *[
            F.sum(F.coalesce(F.col("n") * F.col("w")[i], F.lit(0.0))).alias(f"s{i}") for i in range(len(self.classes))])
        each = [F.struct((F.lit(p) + F.col("m") * b + F.col(f"s{i}")).alias("score"), F.lit(-i).alias("order"))
                for i, (p, b) in enumerate(zip(self.prior, self.base))]
        best = sums.select("doc", F.array_max(F.array(*each)).alias("best"))
        named = F.array(*[F.lit(c) for c in self.classes])
        return best.select(F.col("doc").alias(doc), F.element_at(named, 1 - F.col("best.order")).alias("prediction"),
                           F.col("best.score").alias("score"))


def fit(terms: DataFrame, doc: str = "doc_id", label: str = "label", term: str = "term", n: str = "n",
        kind: str = "multinomial", smoothing: float = 1.0) -> NaiveBayes:
    """``terms``: one row per (document, class, term) with its count.

    multinomial: log P(term | class) = ln((N_ct + s) / (N_c + s V)); Bernoulli:
    P = (D_ct + s) / (D_c + 2 s), absent terms counting too.  Priors are
    ln((D_c + s) / (D + s C))."""
    rows = terms.filter(F.col(label).isNotNull() & F.col(term).isNotNull()).select(
        F.col(doc).alias("doc"), F.col(label).alias("c"), F.col(term).alias("term"),
        (F.lit(1) if kind == "bernoulli" else F.col(n)).cast("double").alias("n"))
    checkpoint_dir(rows.sparkSession)
    cells = rows.groupBy("term", "c").agg(F.sum("n").alias("n")).checkpoint(eager=True)
    docs = rows.groupBy("doc", "c").agg(F.lit(1).alias("one")).groupBy("c").agg(F.count(F.lit(1)).alias("docs"))
    mass = cells.groupBy("c").agg(F.sum("n").alias("mass"), F.count(F.lit(1)).alias("terms"))
    found = sorted((r["c"], r["docs"], r["mass"], r["terms"]) for r in docs.join(mass, "c").collect())   # one row per class
    if not found:
        raise ValueError("no labelled terms")
    size = cells.select("term").distinct().count()
    total, s = sum(r[1] for r in found), smoothing
    classes = [r[0] for r in found]
    prior = [math.log((r[1] + s) / (total + s * len(found))) for r in found]
    cell = lambda c: F.sum(F.when(F.col("c") == F.lit(c), F.col("n")).otherwise(0.0))
    if kind == "bernoulli":
        absent = [math.log((r[1] + s) / (r[1] + 2 * s)) for r in found]              # ln(1 - P) of a term the class lacks
        base = [math.log(s / (r[1] + 2 * s)) - a for r, a in zip(found, absent)]
        odds = [F.log((cell(r[0]) + s) / (F.lit(r[1] + s) - cell(r[0]))) - b for r, b in zip(found, base)]
        lacks = [F.sum(F.log((F.lit(r[1] + s) - F.col("n")) / (r[1] + 2 * s))).alias("v") for r in found]
        for i, r in enumerate(found):                                                # every term absent
            seen = cells.filter(F.col("c") == F.lit(r[0])).agg(lacks[i]).first()[0]
            prior[i] += seen + (size - r[3]) * absent[i]
    else:
        base = [math.log(s / (r[2] + s * size)) for r in found]
        odds = [F.log((cell(r[0]) + s) / s) for r in found]
    weights = cells.groupBy("term").agg(F.array(*odds).alias("w")).checkpoint(eager=True)
    return NaiveBayes(kind, classes, prior, base, weights)
