"""The registered queries: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframe.llm import (bottomk, bpe_words, hard_negatives, hilbert_ann, pii_semicrf, pivotal_mix, quality_gbt, secret_scan,
                          simhash_pigeonring, spelling_fm, suffix_dedup, toxicity_knn, uniform_shards)
from skyframe.llm.common import ready
from skyframe.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return add


@query("op5_source_mix")
def op5(spark, d):
    """Mix of all documents: words taken of each, near its source's target."""
    mixed = pivotal_mix.mix(table(spark, d, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies")


@query("op7_secret_scan")
def op7(spark, d):
    """Secrets in every text: pattern spans and entropy spans."""
    return secret_scan.report(table(spark, d, "documents"))


@query("op9_uniform_shards")
def op9(spark, d):
    """Uniform shuffle of all documents into 16 shards of equal row count."""
    return uniform_shards.shuffle_into_shards(table(spark, d, "documents"))


@query("op4_toxicity")
def op4(spark, d):
    """Toxicity score of every text by its nearest labelled examples."""
    return toxicity_knn.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op10_simhash_components")
def op10(spark, d):
    """Near-duplicate components of all documents by SimHash."""
    found = simhash_pigeonring.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", simhash_pigeonring.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op1_quality")
def op1(spark, d):
    """Quality score of every text by boosted trees over its statistics."""
    return quality_gbt.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op8_bpe_round_trip")
def op8(spark, d):
    """Byte-pair ids of every text, and the text decoded from them."""
    return bpe_words.digests(table(spark, d, "documents"))


@query("op2_bottom_k")
def op2(spark, d):
    """Bottom-k fingerprints of every text and its edited text."""
    return bottomk.edited_report(table(spark, d, "documents"))


@query("op3_hilbert_neighbours")
def op3(spark, d):
    """The 20 nearest rows of every 20th embedding, among all."""
    return hilbert_ann.search(table(spark, d, "embeddings"))


@query("op6_suffix_dedup")
def op6(spark, d):
    """Bytes left of every text after removal of repeated 200-byte strings."""
    return suffix_dedup.digests(table(spark, d, "documents"))


@query("op11_pii")
def op11(spark, d):
    """Personal data in every text: pattern spans and the field's spans."""
    return pii_semicrf.report(table(spark, d, "documents"))


@query("op12_spelling_variants")
def op12(spark, d):
    """Words of all texts, the more frequent word one edit away, and where such steps end."""
    return spelling_fm.group_variants(table(spark, d, "documents"))


@query("op13_hard_negatives")
def op13(spark, d):
    """Rows of another label that score 50 to 95 percent of an anchor's positives."""
    return hard_negatives.mine(table(spark, d, "embeddings"))
