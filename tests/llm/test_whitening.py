import numpy as np
import pytest

from dayloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [None if c is None else float(c) for c in v], i)
                                  for i, v in enumerate(vectors)], SCHEMA).repartition(3)


def expected(vectors, k):
    """n, deviations, whitened, explained by the eigenvectors of the centred covariance."""
    x = np.floor(np.asarray(vectors, np.float32).astype(float) * 256).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    rows = (n * distinct - sums) / n
    values, vectors = np.linalg.eigh(rows.T @ rows / n)
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    return (n, ((n * x - sums).astype(object) ** 2).sum(axis=1), (n * x - sums) / n @ vectors / np.sqrt(values[:k]),
            values[:k] / values.sum())


def agree(got, vectors, k, tolerance=1e-9):
    n, deviations, rows, explained = expected(vectors, k)
    assert len(got) == len(vectors) * k and {r.n for r in got} == {n}
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviations))
    assert max(r.identity_error for r in got) <= 1e-4 and len({r.identity_error for r in got}) == 1
    for c in range(k):
        of = {r.vec_id: r.whitened for r in got if r.component == c + 1}
        column = np.array([of[i] for i in range(len(vectors))])
        sign = 1 if abs(column - rows[:, c]).max() < abs(column + rows[:, c]).max() else -1
        assert abs(sign * column - rows[:, c]).max() < tolerance
        assert {round(r.explained, 9) for r in got if r.component == c + 1} == {round(explained[c], 9)}


def test_components_agree_with_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 12)) @ np.diag(np.linspace(3, 0.2, 12)) + 5
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 400, axis=0)])
    agree(whitening.whitened(frame(spark, vectors), 4).collect(), vectors, 4)


def test_an_offset_and_spreads_far_apart_lose_no_digits(spark):
    """Squares of the offset would drown the small spreads; a plain Cholesky factor of the covariance would not exist."""
    rng = np.random.default_rng(4)
    vectors = (np.round(rng.normal(size=(500, 4)) * np.array([1e6, 1e4, 30, 2]) * 256) / 256 + 4096).astype(np.float32)
    got = whitening.whitened(frame(spark, vectors), 4).collect()
    agree(got, vectors, 4, 1e-6)
    assert max(r.identity_error for r in got) < 1e-8


def test_every_component_and_less_dimensions_than_entries(spark):
    rng = np.random.default_rng(5)
    flat = np.round(rng.normal(size=(300, 3)) * 64) / 64
    vectors = np.column_stack([flat, flat[:, 0] + flat[:, 1], np.zeros(300), flat[:, 2] * 2])
    got = whitening.whitened(frame(spark, vectors)).collect()
    assert {r.component for r in got} == {1, 2, 3}
    agree(got, vectors, 3)


def test_rows_that_are_no_vector_and_others(spark):
    good = [[0.1, 0.2, 0.3], [1, 2, -3], [1, 2, -3], [0.5, -0.25, 8], [7, 7, 7], [0.1, 0.2], []]
    bad = [None, [None, 1, 2], [float("nan"), 0, 0], [float("inf"), 0, 0], [0, float("-inf"), 0]]
    rows = frame(spark, good).unionByName(frame(spark, bad, 100)).selectExpr("*", "1 AS n", "2 AS x", "label AS component", "3 AS i")
    padded = [[*v, *[0.0] * (3 - len(v))] for v in good]
    agree(whitening.whitened(rows, 4).collect(), padded, 3)
    twice = rows.unionByName(rows.withColumn("vec_id", rows["vec_id"] * 0 + 1)).unionByName(
        rows.where("vec_id = 0").selectExpr("CAST(NULL AS long) AS vec_id", *rows.columns[1:]))
    assert whitening.whitened(twice, 4).count() == 3 * 15


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]] * 3, [None, [float("nan")]]])
def test_without_spread_there_is_no_component(spark, vectors):
    rows = frame(spark, vectors) if vectors else spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(rows, 4).collect() == []


def test_entries_beyond_the_grid(spark):
    """Numbers that no 64-bit sum holds are counted exactly; a deviation of more than 38 digits is null."""
    rows = whitening.whitened(frame(spark, [[3e38, 1.0], [1.0, 2.0], [2.0, -3e38]]), 2).collect()
    assert len(rows) == 6 and all(np.isfinite(r.whitened) for r in rows)
    x = np.array([[2 ** 63 - 1, 256], [256, 512], [512, -2 ** 63]], object)
    exact = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert {r.vec_id: r.deviation for r in rows} == {i: v if v < 10 ** 38 else None for i, v in enumerate(exact)}


def test_the_registered_query(spark, tmp_path):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(60, 6)) / 4
    frame(spark, vectors).write.parquet(f"{tmp_path}/embeddings.parquet")
    made = queries.QUERIES["op13_embedding_whitening"](spark, str(tmp_path))
    assert dict(made.dtypes) | {"deviation": "bigint", "component": "int", "vec_id": "bigint", "n": "bigint"} == dict(made.dtypes)
    agree(made.collect(), vectors, 4)


def test_solves_undo_the_factor():
    rng = np.random.default_rng(8)
    for d in (1, 5, 32, 70):
        factor = np.triu(rng.normal(size=(d, d))) + 4 * np.eye(d)
        rows = rng.normal(size=(9, d))
        assert np.allclose(whitening.solved(rows, factor) @ factor, rows)
