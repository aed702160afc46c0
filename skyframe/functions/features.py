"""Feature operators: text tokenising, term weighting, scaling, encoding,
vector assembly and transforms.

Where an operator is a closed-form column expression it is written as one
(so it stays inside whole-stage code generation and its result can be
checked by SQL); estimators that learn state (scalers, indexers, IDF,
vocabularies) fit with one aggregate and then apply an expression.  The
``pyspark.ml`` stages are offered as well for use inside pipelines.
"""

from __future__ import annotations

from pyspark.ml import feature as mlf
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------- text
def tokenize(df: DataFrame, col: str, out: str = "tokens") -> DataFrame:
    """Lower-case, split on single whitespace characters (Tokenizer)."""
    return mlf.Tokenizer(inputCol=col, outputCol=out).transform(df)


def regex_tokenize(df: DataFrame, col: str, pattern: str = r"\W", gaps: bool = True,
                   min_length: int = 1, out: str = "tokens", lowercase: bool = True) -> DataFrame:
    """Tokens between (``gaps``) or of the matches of ``pattern``, at least
    ``min_length`` characters long.  Built-in functions: the ML tokenizer is
    opaque to the optimizer and runs outside generated code."""
    text = F.lower(F.col(col)) if lowercase else F.col(col)
    tokens = F.split(text, pattern) if gaps else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if min_length == 1:
        tokens = F.array_remove(tokens, "")
    elif min_length > 1:
        tokens = F.filter(tokens, lambda t: F.length(t) >= min_length)
    return df.withColumn(out, tokens)


def remove_stopwords(df: DataFrame, col: str, out: str = "filtered", extra: list[str] | None = None,
                     words: list[str] | None = None, case_sensitive: bool = False) -> DataFrame:
    """Drop stop words (default English list, plus ``extra``); ``words``
    replaces the list entirely."""
    r = mlf.StopWordsRemover(inputCol=col, outputCol=out, caseSensitive=case_sensitive)
    base = words if words is not None else list(r.getStopWords())
    r.setStopWords(base + list(extra or []))
    return r.transform(df)


def ngrams(df: DataFrame, col: str, n: int = 2, out: str = "ngrams") -> DataFrame:
    """Space-joined n-grams; inputs shorter than n give an empty array."""
    return mlf.NGram(n=n, inputCol=col, outputCol=out).transform(df)


CHARS_PER_TASK = 8_000_000


def spread(df: DataFrame, col: str, chars: int | None = None) -> DataFrame:
    """Rows dealt anew so that a task has about ``chars`` characters of ``col``, however
    large the files' parts are: what a task gathers from its text then stays small."""
    total = df.agg(F.sum(F.length(col))).first()[0] or 0
    return df.repartition(max(1, -(-total // (chars or CHARS_PER_TASK))))


def hashing_tf(df: DataFrame, col: str, n: int = 1 << 18, out: str = "tf", binary: bool = False) -> DataFrame:
    return mlf.HashingTF(inputCol=col, outputCol=out, numFeatures=n, binary=binary).transform(df)


def idf(df: DataFrame, col: str, min_df: int = 0, out: str = "tfidf") -> DataFrame:
    """Fit IDF on term-frequency vectors and scale them."""
    return mlf.IDF(inputCol=col, outputCol=out, minDocFreq=min_df).fit(df).transform(df)


def idf_terms(docs: DataFrame, doc_col: str, tokens_col: str, min_df: int = 0) -> DataFrame:
    """Term-level IDF without hashing: idf = ln((N + 1) / (df + 1)),
    0 for terms below ``min_df``.  One distinct + one aggregate."""
    n = docs.agg(F.count(F.lit(1))).scalar()              # scalar subquery, no join
    dfreq = (docs.select(doc_col, F.explode(F.array_distinct(tokens_col)).alias("term"))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")))
    j = dfreq.withColumn("_n", n)
    weight = F.when(F.col("doc_freq") >= min_df, F.log((F.col("_n") + 1) / (F.col("doc_freq") + 1))).otherwise(0.0)
    return j.select("term", "doc_freq", weight.alias("idf"))


def count_vectors(df: DataFrame, col: str, vocab_size: int = 1 << 18, min_df: float = 1.0,
                  vocabulary: list[str] | None = None, out: str = "counts"):
    """CountVectorizer; with ``vocabulary`` the a-priori form is used.
    Returns (transformed DataFrame, vocabulary list)."""
    if vocabulary is not None:
        model = mlf.CountVectorizerModel.from_vocabulary(vocabulary, inputCol=col, outputCol=out)
    else:
        model = mlf.CountVectorizer(inputCol=col, outputCol=out, vocabSize=vocab_size, minDF=min_df).fit(df)
    return model.transform(df), list(model.vocabulary)


def vocabulary(df: DataFrame, col: str, min_df: int = 1) -> DataFrame:
    """(term, doc_freq) of all terms in at least ``min_df`` rows: one
    aggregate, no bound on the vocabulary and nothing on the driver."""
    return (df.select(F.explode(F.array_distinct(col)).alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("doc_freq")).filter(F.col("doc_freq") >= min_df))


def word2vec(df: DataFrame, col: str, dim: int = 3, min_count: int = 0, seed: int = 42, out: str = "vector",
             partitions: int | None = None):
    """Word2Vec; returns (model, transformed) -- the doc vector is the mean
    of its word vectors; ``model.findSynonyms(word, n)`` gives neighbours.

    Training runs in ``partitions`` parallel tasks (default: the cluster's
    parallelism) whose vectors are averaged, not in a single task."""
    n = partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
    model = mlf.Word2Vec(vectorSize=dim, minCount=min_count, inputCol=col, outputCol=out, seed=seed,
                         numPartitions=n).fit(df)
    return model, model.transform(df)


# ---------------------------------------------------------------- numeric columns
def binarize(df: DataFrame, col: str, threshold: float, out: str | None = None) -> DataFrame:
    """1.0 when x > threshold, else 0.0."""
    return df.withColumn(out or f"{col}_bin", F.when(F.col(col) > threshold, 1.0).otherwise(0.0))


def bucketize(df: DataFrame, col: str, splits: list[float], out: str | None = None) -> DataFrame:
    """Bucket index of x in splits: [s_i, s_i+1), the last bucket closed."""
    x = F.col(col)
    e = F.lit(None).cast("double")
    last = len(splits) - 2
    for i in range(last, -1, -1):
        lo, hi = splits[i], splits[i + 1]
        cond = (x >= lo) & ((x <= hi) if i == last else (x < hi))
        e = F.when(cond, float(i)).otherwise(e)
    return df.withColumn(out or f"{col}_bucket", e)


def quantile_buckets(df: DataFrame, col: str, n: int, out: str | None = None, relative_error: float = 0.001):
    return mlf.QuantileDiscretizer(numBuckets=n, inputCol=col, outputCol=out or f"{col}_q",
                                   relativeError=relative_error).fit(df).transform(df)


def index_strings(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Index by frequency (most frequent = 0), ties alphabetically.  One
    aggregate over the distinct labels; the label table is joined back
    (broadcast when small)."""
    from skyframe.operators.relational import with_index
    from skyframe.plans.joins import broadcast_if_small
    counts = (df.groupBy(col).agg(F.count(F.lit(1)).alias("_c")).filter(F.col(col).isNotNull())
                .withColumn("_neg", -F.col("_c")))
    # ranks over the distinct labels without a single-partition window
    ranked = with_index(counts, ["_neg", col], "_idx")
    labels = ranked.select(col, F.col("_idx").cast("double").alias(out or f"{col}_index"))
    return df.join(broadcast_if_small(labels), col, "left")


def string_indexer(df: DataFrame, col: str, out: str | None = None):
    """pyspark.ml StringIndexer (keeps the labels in column metadata)."""
    return mlf.StringIndexer(inputCol=col, outputCol=out or f"{col}_index",
                             stringOrderType="frequencyDesc").fit(df)


def unindex(df: DataFrame, col: str, out: str, labels: list[str] | None = None) -> DataFrame:
    """IndexToString: index -> label (from metadata or ``labels``)."""
    t = mlf.IndexToString(inputCol=col, outputCol=out)
    if labels is not None:
        t.setLabels(labels)
    return t.transform(df)


def one_hot(df: DataFrame, col: str, size: int, out: str | None = None, drop_last: bool = True) -> DataFrame:
    """Index -> indicator array of length size - 1 (last category dropped)."""
    n = size - 1 if drop_last else size
    idx = F.col(col).cast("int")
    arr = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.when(j == idx, 1.0).otherwise(0.0)) \
        if n > 0 else F.array().cast("array<double>")
    return df.withColumn(out or f"{col}_vec", array_to_vector(arr))


def one_hot_ml(df: DataFrame, col: str, out: str | None = None):
    return mlf.OneHotEncoder(inputCols=[col], outputCols=[out or f"{col}_vec"]).fit(df).transform(df)


def index_vector(df: DataFrame, col: str, max_categories: int = 10, out: str = "indexed"):
    model = mlf.VectorIndexer(inputCol=col, outputCol=out, maxCategories=max_categories).fit(df)
    return model, model.transform(df)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return mlf.VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def slice_vector(df: DataFrame, col: str, indices: list[int] | None = None, names: list[str] | None = None,
                 out: str = "sliced") -> DataFrame:
    s = mlf.VectorSlicer(inputCol=col, outputCol=out)
    if indices:
        s.setIndices(indices)
    if names:
        s.setNames(names)
    return s.transform(df)


def interact(df: DataFrame, cols: list[str], out: str = "interaction") -> DataFrame:
    return mlf.Interaction(inputCols=cols, outputCol=out).transform(df)


def poly(df: DataFrame, col: str, degree: int = 2, out: str = "poly") -> DataFrame:
    return mlf.PolynomialExpansion(degree=degree, inputCol=col, outputCol=out).transform(df)


def scale_by(df: DataFrame, col: str, weights: list[float], out: str = "scaled") -> DataFrame:
    """Elementwise (Hadamard) product with a fixed weight vector."""
    from pyspark.ml.linalg import Vectors
    return mlf.ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=col, outputCol=out).transform(df)


def normalize(df: DataFrame, col: str, p: float = 2.0, out: str = "normalized") -> DataFrame:
    """Unit p-norm (p = inf for max norm); a zero vector stays zero."""
    return mlf.Normalizer(p=p, inputCol=col, outputCol=out).transform(df)


def _col_stats(df: DataFrame, col: str, dims: int, funcs: dict):
    a = vector_to_array(F.col(col))
    return df.agg(*[f(a[i]).alias(f"{name}_{i}") for name, f in funcs.items() for i in range(dims)]).first()


def standardize(df: DataFrame, col: str, with_mean: bool = False, with_std: bool = True,
                out: str = "scaled"):
    return mlf.StandardScaler(inputCol=col, outputCol=out, withMean=with_mean, withStd=with_std).fit(df).transform(df)


def minmax(df: DataFrame, col: str, out: str = "scaled", lo: float = 0.0, hi: float = 1.0):
    return mlf.MinMaxScaler(inputCol=col, outputCol=out, min=lo, max=hi).fit(df).transform(df)


def maxabs(df: DataFrame, col: str, out: str = "scaled"):
    return mlf.MaxAbsScaler(inputCol=col, outputCol=out).fit(df).transform(df)


def impute(df: DataFrame, cols: list[str], strategy: str = "mean", suffix: str = "") -> DataFrame:
    """Missing values (null or NaN) -> column mean / median / mode."""
    outs = [c + suffix for c in cols]
    return mlf.Imputer(inputCols=cols, outputCols=outs, strategy=strategy).fit(df).transform(df)


def dct(df: DataFrame, col: str, inverse: bool = False, out: str = "dct") -> DataFrame:
    return mlf.DCT(inverse=inverse, inputCol=col, outputCol=out).transform(df)


def pca(df: DataFrame, col: str, k: int, out: str = "pca"):
    model = mlf.PCA(k=k, inputCol=col, outputCol=out).fit(df)
    return model, model.transform(df)


def chisq_select(df: DataFrame, n: int, features: str = "features", label: str = "label",
                 out: str = "selected"):
    sel = mlf.UnivariateFeatureSelector(featuresCol=features, outputCol=out, labelCol=label,
                                        selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(n)
    model = sel.fit(df)
    return model, model.transform(df)


def rformula(df: DataFrame, formula: str, features: str = "features", label: str = "label"):
    return mlf.RFormula(formula=formula, featuresCol=features, labelCol=label).fit(df).transform(df)


def sql_transform(df: DataFrame, statement: str) -> DataFrame:
    """``SELECT ... FROM __THIS__`` over the input (SQLTransformer)."""
    return mlf.SQLTransformer(statement=statement).transform(df)


def vector_roundtrip(df: DataFrame, path: str) -> DataFrame:
    """Write vectors to Parquet and read them back (the vector type is kept)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def as_array(df: DataFrame, col: str, digits: int | None = None, out: str | None = None) -> DataFrame:
    """Vector -> array<double>, optionally rounded (for comparisons)."""
    a = vector_to_array(F.col(col))
    if digits is not None:
        a = F.transform(a, lambda x: F.round(x, digits))
    return df.withColumn(out or col, a)
