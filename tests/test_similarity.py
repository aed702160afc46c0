import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skyframe.functions import similarity as sim


@pytest.mark.parametrize("tile", [None, 7])
def test_approx_join_gives_the_models_pairs_without_writing_candidates(spark, tile):
    x = np.random.default_rng(3).normal(size=(80, 5)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5, x[5].tolist()), (90, x[7].tolist())]
    df = spark.createDataFrame(rows, "id long, a array<double>").select("id", array_to_vector("a").alias("features"))
    m = sim.brp(df, 0.4, 3)
    want = m.approxSimilarityJoin(df, df, 1.5, distCol="d").select(F.col("datasetA.id"), F.col("datasetB.id"), "d")
    got = sim._tiled_join(m, df, df, 1.5, "id", "d", tile) if tile else sim.approx_join(m, df, df, 1.5, dist="d")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("id_a = 7 and id_b = 90").first()["d"] == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" in plan and "datasetA" not in plan
