import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import balance, neighbours


def brute_force(vectors, copies, k):
    """Neighbour lists of distinct vectors by looking at every pair."""
    found = {}
    for i, v in enumerate(vectors):
        gaps = ((vectors - v) ** 2).sum(axis=1)
        near = [tuple(v)] * min(k, copies[i] - 1)
        for j in np.lexsort((np.arange(len(vectors)), gaps)):
            if j != i:
                near += [tuple(vectors[j])] * max(0, min(copies[j], k - len(near)))
        found[tuple(v)] = near[:k]
    return found


@pytest.mark.parametrize("box_rows", [10_000, 40])
@pytest.mark.parametrize("partitions", [1, 5])
def test_neighbours_match_brute_force(spark, box_rows, partitions):
    rng = np.random.default_rng(1)
    vectors = np.unique(np.round(rng.normal(size=(700, 3)) * 3) / 3, axis=0)
    copies = rng.integers(1, 4, size=len(vectors))
    copies[::50] = 1000
    rows = [(i, int(c), v.tolist()) for i, (v, c) in enumerate(zip(vectors, copies))]
    points = spark.createDataFrame(rows, "pid bigint, copies bigint, vector array<double>")
    got = neighbours.nearest_neighbours(points.repartition(partitions), 5, box_rows).collect()
    found = {tuple(r["vector"]): [tuple(n) for n in r["neighbours"]] for r in got}
    assert found == brute_force(vectors, copies, 5)


def numbered(spark, vectors):
    rows = [(i, 1 + i % 3, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "pid bigint, copies bigint, vector array<double>")


def test_full_boxes_are_cut_again(spark, monkeypatch):
    """A first tree of few boxes: later rounds keep the largest box as small while rows grow 16 times."""
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 64)
    monkeypatch.setattr(neighbours, "SPLIT_SAMPLE", 256)
    rng = np.random.default_rng(3)
    largest = {}
    for n in (1_000, 16_000):
        points = numbered(spark, rng.normal(size=(n, 3)))
        first = neighbours._boxed(points, n, 10)
        boxed, rounds = neighbours.split_boxes(first, 10)
        sizes = [r["count"] for r in boxed.groupBy("box").count().collect()]
        assert sum(sizes) == n and rounds >= 1
        largest[n] = max(sizes)
    assert max(largest.values()) <= neighbours.FULL_BOXES * 10
    assert max(r["count"] for r in first.groupBy("box").count().collect()) > 500


def test_boxes_in_levels_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLE_ROWS", 48)
    monkeypatch.setattr(neighbours, "SPLIT_SAMPLE", 64)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 16)
    monkeypatch.setattr(neighbours, "POINT_ROWS", 16)
    rng = np.random.default_rng(4)
    vectors = np.unique(np.round(rng.normal(size=(900, 2)) * 9) / 9, axis=0)
    points = numbered(spark, vectors)
    _, rounds = neighbours.split_boxes(neighbours._boxed(points, len(vectors), 4), 4)
    assert rounds >= 2
    got = neighbours.nearest_neighbours(points, 5, 4).collect()
    found = {tuple(r["vector"]): [tuple(n) for n in r["neighbours"]] for r in got}
    assert found == brute_force(vectors, [1 + i % 3 for i in range(len(vectors))], 5)


def test_points_too_near_for_a_cut_stay_in_one_box(spark):
    vectors = np.array([[i * 5e-324] for i in range(200)])
    boxed = numbered(spark, vectors).withColumn("box", F.lit("0"))
    same, rounds = neighbours.split_boxes(boxed, 4)
    assert rounds == 0 and same.select("box").distinct().count() == 1


@pytest.mark.parametrize("width", [3, 20])
def test_projected_search_reaches_its_recall(spark, width):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, width)) * 4
    vectors = centres[rng.integers(0, 30, 6_000)] + rng.normal(size=(6_000, width)) * rng.random((6_000, 1))
    points = numbered(spark, vectors)
    found = neighbours.projected_neighbours(points, 5, bucket_rows=512)
    row = neighbours.recall(found, points, 5, every=20).first()
    assert row["queries"] > 200 and row["wanted"] == 5 * row["queries"] and row["recall"] >= 0.9
    own = neighbours.recall(neighbours.nearest_neighbours(points, 5, 512), points, 5, every=20).first()
    assert own["recall"] == 1.0
    none = neighbours.recall(found.filter("false"), points, 5, every=20).first()
    assert none["hits"] == 0 and none["recall"] == 0.0


def test_projected_search_without_points(spark):
    points = numbered(spark, np.zeros((0, 2)))
    assert neighbours.projected_neighbours(points, 5).count() == 0
    assert neighbours.recall(points.select("vector", F.array("vector").alias("neighbours")), points, 5).first()[:3] == (0, 0, 0)


def test_box_distance_never_exceeds_a_point_inside():
    rng = np.random.default_rng(2)
    points, queries = rng.normal(size=(200, 6)), rng.normal(size=(50, 6)) * 3
    boxes = neighbours.box_of(neighbours.grow_tree(points, 10), points)
    for box in np.unique(boxes):
        inside = points[boxes == box]
        assert len(inside) <= 10
        gap = neighbours.box_distances(queries, inside.min(axis=0)[None], inside.max(axis=0)[None])
        assert (gap <= neighbours.squared_distances(queries, inside) + 0.0).all()


def test_tree_splits_mostly_equal_values():
    points = np.array([[0.0, i] for i in range(5)] + [[1.0, i] for i in range(95)])
    boxes = neighbours.box_of(neighbours.grow_tree(points, 8), points)
    assert np.unique(boxes, return_counts=True)[1].max() <= 8


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(400).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 10 == 0).cast("int").alias("churn"),
        (F.col("id") * 37 % 101).cast("double").alias("a"),
        (F.col("id") * 61 % 89).cast("int").alias("b"),
    )


def test_oversampling_invariants(skewed):
    grown = balance.smote(skewed, ["a", "b"]).toPandas()
    assert grown["churn"].value_counts().to_dict() == {0: 360, 1: 360}
    originals = grown[grown["copy_no"] == 0].sort_values("customer_id")
    given = skewed.toPandas()
    assert originals[["customer_id", "churn", "a", "b"]].values.tolist() == given.values.tolist()
    minority = given[given["churn"] == 1]
    points = minority[["a", "b"]].to_numpy(float)
    near = brute_force(points, np.ones(len(points), int), 5)
    source = dict(zip(minority["customer_id"], map(tuple, points)))
    made = grown[grown["copy_no"] > 0]
    quotas = made.groupby("customer_id").size()
    assert quotas.max() - quotas.min() <= 1 and len(quotas) == 40
    for row in made.itertuples():
        x, start = np.array([row.a, row.b]), np.array(source[row.customer_id])
        offsets = [np.array(n) - start for n in near[source[row.customer_id]]]
        moved = x - start
        assert any(
            abs(moved[0] * o[1] - moved[1] * o[0]) < 1e-9 and -1e-9 <= moved @ o <= o @ o + 1e-9
            for o in offsets
        )


def test_oversampling_ignores_partitioning(skewed):
    def rows(df):
        return sorted(map(str, balance.smote(df, ["a", "b"]).collect()))

    assert rows(skewed.repartition(1)) == rows(skewed.repartition(13))
    assert rows(skewed) == sorted(map(str, balance.smote(skewed, ["a", "b"], box_rows=8).collect()))


def test_oversampling_with_projections(skewed):
    grown = balance.smote(skewed, ["a", "b"], search="projected")
    assert balance.class_counts(grown, "churn") == {0: 360, 1: 360}
    with pytest.raises(ValueError, match="unknown search"):
        balance.smote(skewed, ["a", "b"], search="guess")


def test_few_and_repeated_minority_rows(spark):
    rows = [(i, 0, float(i)) for i in range(10)] + [(20, 1, 5.0)]
    lone = balance.smote(spark.createDataFrame(rows, "customer_id bigint, churn int, a double"), ["a"])
    assert {r["a"] for r in lone.filter("churn = 1").collect()} == {5.0}
    assert lone.filter("churn = 1").count() == 10
    rows += [(21, 1, 5.0), (22, 1, 7.0)]
    few = balance.smote(spark.createDataFrame(rows, "customer_id bigint, churn int, a double"), ["a"])
    made = few.filter("churn = 1").toPandas()
    assert len(made) == 10 and made["a"].between(5, 7).all()


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_a_row_without_key_takes_part(spark, kind):
    rows = [(i, 0, float(i), 1.0) for i in range(30)]
    rows += [(None, 1, 3.0, 2.0), (2**60 + 1, 1, 5.0, 4.0), (2**60 + 2, 1, 9.0, 6.0)]
    df = spark.createDataFrame(rows, "customer_id bigint, churn int, a double, b double")
    df = df.withColumn("customer_id", F.col("customer_id").cast(kind))
    made = balance.smote(df, ["a", "b"]).filter("copy_no > 0")
    assert made.count() == 27
    assert made.groupBy("customer_id").count().filter("count = 9").count() == 3
    corners = [(3.0, 2.0), (5.0, 4.0), (9.0, 6.0)]
    assert made.filter(F.struct("a", "b").isin(*[F.struct(F.lit(x), F.lit(y)) for x, y in corners])).count() < 5


def test_large_quota_is_generated_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(balance, "COPIES_PER_BLOCK", 7)
    df = spark.range(103).select(
        F.col("id").alias("customer_id"), (F.col("id") > 99).cast("int").alias("churn"),
        F.col("id").cast("double").alias("a"),
    )
    made = balance.smote(df, ["a"]).filter("copy_no > 0").toPandas()
    assert len(made) == 97 and not made.duplicated(["customer_id", "copy_no"]).any()


def test_more_than_two_classes(spark):
    df = spark.range(60).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") < 40, "x").when(F.col("id") < 54, "y").otherwise("z").alias("churn"),
        F.col("id").cast("double").alias("a"),
    )
    sizes = balance.class_counts(balance.smote(df, ["a"]), "churn")
    assert sizes == {"x": 40, "y": 40, "z": 40}


def test_gate_and_weights(spark):
    assert balance.needs_rebalancing({0: 100, 1: 49})
    assert not balance.needs_rebalancing({0: 100, 1: 50})
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "churn int")
    weights = {r["churn"]: r["weight"] for r in balance.class_weights(df).collect()}
    assert weights == {0: 4 / 6, 1: 2.0}
    by_row = df.select("churn", balance.weight_column(balance.class_counts(df, "churn"), "churn"))
    assert {tuple(r) for r in by_row.collect()} == set(weights.items())


def test_rows_without_a_label_belong_to_no_class(spark):
    rows = [(k, None if k % 5 == 0 else int(k % 5 == 1), float(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "customer_id long, churn int, x double")
    assert balance.class_counts(df, "churn") == {0: 24, 1: 8}
    assert balance.smote(df, ["x"]).groupBy("churn").count().orderBy("churn").collect() == [(0, 24), (1, 24)]
    assert {r.churn for r in balance.class_weights(df).collect()} == {0, 1}
    assert balance.smote(df.filter("false"), ["x"]).count() == 0
    assert not balance.needs_rebalancing({})
    with pytest.raises(ValueError, match="values"):
        balance.class_counts(spark.range(2000).withColumnRenamed("id", "churn"), "churn")


def test_a_query_oversamples_on_all_prepared_features(spark):
    import registry
    from keepwell.sources.star_binding import StarBinding

    folder = "/root/testdata/sf0.001"
    names = registry.prepared(StarBinding(spark, folder))[0].names
    grown = registry.queries()["smote_prepared"](spark, folder)
    assert set(names) < set(grown.columns) and len(names) > 20
    assert len({r["count"] for r in grown.groupBy("churn").count().collect()}) == 1


@pytest.mark.parametrize("box_rows", [2_048, 8])
def test_parts_oversampled_together_are_as_each_alone(spark, skewed, monkeypatch, box_rows):
    """Overlapping parts of one table with repeated points and a row without key, in one pass of the search."""
    more = [(None, 1, 3.0, 2), (1_000, 1, 3.0, 2), (1_001, 1, 3.0, 2), (1_002, 2, 7.0, 1), (1_003, 2, 9.0, 4), (1_004, None, 1.0, 1)]
    table = skewed.unionByName(spark.createDataFrame(more, "customer_id long, churn int, a double, b int")).withColumn("cut", F.coalesce(F.col("customer_id"), F.lit(0)) % 3)
    table = balance.materialise(table, "test")
    conditions = {i: F.col("cut") != i for i in range(4)}
    parts = {i: (inside, balance.class_counts(table.filter(inside), "churn")) for i, inside in conditions.items()}
    written, write = [], balance.materialise
    monkeypatch.setattr(balance, "materialise", lambda df, label: written.append(label) or write(df, label))
    together = balance.smote_parts(table, ["a", "b"], parts, box_rows=box_rows)
    assert written == ["minority", "points"]
    for i, inside in conditions.items():
        alone = balance.smote(table.filter(inside), ["a", "b"], box_rows=box_rows).filter("copy_no > 0")
        found = together.filter(F.col("part") == i).drop("part")
        assert found.columns == alone.columns and sorted(map(str, found.collect())) == sorted(map(str, alone.collect()))
        assert alone.count() > 200
    assert balance.smote_parts(table, ["a", "b"], {0: (conditions[0], {0: 5, 1: 5})}) is None


def test_the_sample_of_the_first_boxes_stays_on_the_executors(spark, monkeypatch):
    points = numbered(spark, np.random.default_rng(6).normal(size=(300, 3)))
    monkeypatch.setattr(type(points), "toPandas", lambda _: pytest.fail("sample on the driver"))
    boxes = neighbours._boxed(points, 300, 40).groupBy("box").count().collect()
    assert 300 / 40 < len(boxes) < 300 / 40 * 3 and max(r["count"] for r in boxes) <= 40
