"""The id filter inside the vector scan: Spark's bitmaps read in the tasks, and the fallback."""

import numpy as np
from pyspark.sql import functions as F

from popscope.operators import search as S


def test_bits_agree_with_spark(spark):
    ids = [0, 1, 2, 7, 8, 32767, 32768, 32769, 65536, -1, -5, -32768, -32769, 2**40 + 3, 2**62]
    allowed = spark.createDataFrame([(i,) for i in ids[::2]] + [(None,)], "id long")
    bits = S.allowed_bits(allowed)
    got = S.in_bits(np.array(ids, np.int64), bits)
    assert got.tolist() == [i in set(ids[::2]) for i in ids]


def test_filtered_topk_equals_semi_join(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=4)]) for i in range(-50, 400)]
    index = spark.createDataFrame(rows + [(1000, None)], "id long, vec array<float>").repartition(5)
    allowed = spark.createDataFrame([(i,) for i in range(-50, 400, 3)] + [(1000,)], "id long")
    vector = [0.5, -1.0, 0.25, 2.0]
    plain = S.vector_scores(index, vector).join(allowed, "id", "left_semi").orderBy(F.desc("score"), "id").limit(7)
    bits = S.allowed_bits(allowed)
    fast = S.allowed_topk(index, vector, 7, bits).orderBy(F.desc("score"), "id").limit(7)
    assert [tuple(r) for r in fast.collect()] == [tuple(r) for r in plain.collect()]
    assert S.allowed_topk(index, vector, 7, bits).count() <= 5 * 7  # tasks x k rows travel
    assert S.allowed_bits(allowed, most=0) is None  # too many buckets: the join of all scores
