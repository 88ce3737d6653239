import numpy as np
import pytest

from seasonframe.llm.embedding_dedup import buckets, hadamard, near_vectors, unit_rows

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, kept int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], SCHEMA)


def brute(rows, cosine=0.98):
    ok = []
    for i, v, label in rows:
        fine = v and label is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(unit_rows(np.array([v], np.float32))[0] if fine else None)
    n = len(rows)
    links = [
        [j for j in range(n) if j != i and ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2]
         and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine]
        for i in range(n)
    ]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen) if rows[i][0] is not None else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=repr)


def clusters(rng, count, size, width, spread):
    centres = rng.normal(size=(count, width))
    return [(centres[c] + spread * rng.normal(size=width)).astype(np.float32) for c in range(count) for _ in range(size)]


@pytest.mark.parametrize("slice_rows", [1024, 5])
def test_links_and_components_equal_brute_force(spark, slice_rows):
    rng = np.random.default_rng(7)
    vectors = clusters(rng, 12, 15, 48, 0.12) + clusters(rng, 40, 1, 48, 1)
    rows = [(100 + i, v.tolist(), i % 2) for i, v in enumerate(vectors)]
    rows += [(300 + i, vectors[0].tolist(), 0) for i in range(20)]  # copies
    rows += [(400, (2 * vectors[0]).tolist(), 0)]  # the same direction
    nan, inf = float("nan"), float("inf")
    for i, v in enumerate([None, [], [0.0] * 48, [nan] * 48, [inf] * 48, [None] * 48, vectors[0].tolist()[:47]]):
        rows += [(500 + i, v, 0), (600 + i, v, 0)]
    rows += [(700, vectors[0].tolist(), None), (701, vectors[0].tolist(), None), (None, vectors[0].tolist(), 0)]
    got = sorted((tuple(r) for r in near_vectors(table(spark, rows), slice_rows=slice_rows).collect()), key=repr)
    assert got == brute(rows)


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    for width in (32, 64, 200):
        a = unit_rows(rng.normal(size=(1500, width)))
        noise = rng.normal(size=a.shape)
        noise = unit_rows(noise - (noise * a).sum(axis=1, keepdims=True) * a)
        b = 0.98 * a + np.sqrt(1 - 0.98**2) * noise
        x, y = buckets(a), buckets(b)
        met = (x[:, :, 0][:, :, None] == y).any(axis=2) | (y[:, :, 0][:, :, None] == x).any(axis=2)
        assert met.any(axis=1).mean() > 0.99


def test_transform_is_orthogonal():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(hadamard(hadamard(x)), 64 * x)


def test_empty_table(spark):
    assert near_vectors(table(spark, [])).collect() == []


def test_an_id_on_different_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 24))
    rows = [(int(rng.integers(0, 12)), (base[i % 6] + 0.04 * rng.normal(size=24)).astype(np.float32).tolist(), 0) for i in range(60)]
    rows += [(1, rows[0][1], 0), (1, rows[1][1], 0), (1, rows[0][1], 0)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    unit = np.array([r[1] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.98
    np.fill_diagonal(near, False)
    reach = np.linalg.matrix_power((near | np.eye(len(rows), dtype=bool)).astype(float), 64) > 0
    want = sorted((rows[i][0], int(near[i].sum()), min(rows[j][0] for j in np.flatnonzero(reach[i]))) for i in range(len(rows)))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
