"""Near-duplicate vectors against brute force."""

import numpy as np

from tripmill.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, copies int, x int, n_links string"


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], SCHEMA)


def brute(rows):
    sound = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None]
    sound = [r for r in sound if None not in r[1] and np.isfinite(np.array(r[1], float)).all() and np.any(r[1])]
    links = {k: [] for k in range(len(sound))}
    for a, (_, va, la) in enumerate(sound):
        for b, (_, vb, lb) in enumerate(sound):
            if a != b and la == lb and len(va) == len(vb):
                x, y = np.float32(va).astype(float), np.float32(vb).astype(float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    links[a].append(b)
    root = {k: sound[k][0] for k in links}
    changed = True
    while changed:
        changed = False
        for a, bs in links.items():
            low = min([root[a], *(root[b] for b in bs)])
            changed, root[a] = changed or low != root[a], low
    result = [(r[0], len(links[k]), root[k], r[0] == root[k]) for k, r in enumerate(sound)]
    rest = [r for r in rows if not any(r is s for s in sound)]
    return result + [(r[0], 0, r[0], True) for r in rest]


def key(r):
    return tuple((v is not None, v) for v in r)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for center in range(12):
        base = rng.normal(size=16) * (1 + np.arange(16)[::-1] / 4)
        for _ in range(int(rng.choice([1, 3, 30]))):
            v = base + rng.normal(size=16) * rng.choice([0, 0.1, 0.3]) * rng.integers(0, 2)
            rows.append((len(rows), [float(x) for x in np.float32(v)], center % 3))
    n = len(rows)
    rows += [
        (n, None, 1),
        (n + 1, [0.0] * 16, 1),
        (n + 2, rows[0][1][:15] + [None], 0),
        (n + 3, rows[0][1][:15] + [float("nan")], 0),
        (n + 4, rows[0][1][:15] + [float("inf")], 0),
        (n + 5, rows[0][1], None),
        (n + 6, [1.0, 2.0], 1),
        (n + 7, [2.0, 4.0], 1),
        (n + 8, [], 1),
        (None, rows[0][1], 0),
        (n + 9, [5.0], 2),
        (n + 10, [-5.0], 2),
    ]
    got = vectors.near_vectors(make(spark, rows), block_rows=8).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_copies_and_repeated_rows(spark):
    rows = [(i, [1.0, float(i % 2), 3.0], 7) for i in range(40)] + [(3, [1.0, 1.0, 3.0], 7)]
    got = vectors.near_vectors(make(spark, rows), block_rows=4).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_nothing(spark):
    assert vectors.near_vectors(make(spark, [])).count() == 0


def test_early_stop_loses_no_pair():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 32))
    x[100:] = x[rng.integers(0, 100, 200)] + rng.normal(size=(200, 32)) * 0.15
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    every = np.arange(300)
    got = {tuple(p) for p in vectors.links_in_tile(x, every, every, axes, 0.98)}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    wanted = {(i, j) for i, j in zip(*np.nonzero(unit @ unit.T >= 0.98), strict=True) if i < j}
    assert got == wanted and wanted
