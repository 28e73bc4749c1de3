"""Property checks from the survey's test strategy, on generated inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import kmeans as K
from tessera.operators import silhouette as SIL

points = st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), min_size=3, max_size=60)


@settings(max_examples=8, deadline=None)
@given(xy=points, k=st.integers(1, 4))
def test_round_sizes_sum_to_n_and_are_shuffle_independent(spark, xy, k):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "pid long, x int, y int")
    seeds = xy[:k]
    results = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            results.append(K.fit2d(df, seeds, 6))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    a, b = results
    assert a.centroids == b.centroids and a.iterations == b.iterations and a.converged == b.converged
    assert sum(a.sizes) == len(xy)


@settings(max_examples=8, deadline=None)
@given(xy=points, k=st.integers(2, 4), block=st.sampled_from([2, 5, 4096]))
def test_silhouette_is_bounded(spark, xy, k, block):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "pid long, x int, y int")
    a = K.assign2d(df, xy[:k])
    for r in SIL.silhouette_points(a, block_rows=block).collect():
        s = r["silhouette"]
        assert s is None or -1.0 - 1e-12 <= s <= 1.0 + 1e-12
