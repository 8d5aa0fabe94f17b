"""Product codes over cover trees against plain Lloyd rounds."""

import hashlib

import numpy as np
import pytest

from tripmill.llm import cover_trees
from tripmill.llm.cover_trees import CoverTree

SCHEMA = "vec_id long, embedding array<float>, label int, size int, parts string, code int, error long, points string"


def make(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", 2, 3, "q") for r in rows], SCHEMA)


def brute(rows):
    kept = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite(np.array(r[1], float)).all()]
    out = []
    for size in {len(r[1]) for r in kept}:
        own = [(i, [int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v], label) for i, v, label in kept if len(v) == size]
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        edges = [i * size // 8 for i in range(9)]
        codes, errors, numbers = [[] for _ in own], [0] * len(own), []
        for a, b in zip(edges, edges[1:], strict=False):
            points = [r[1][a:b] for r in own]
            entries = points[:16]

            def nearest(p, entries=entries):
                return min((sum((x - y) ** 2 for x, y in zip(p, c, strict=True)), e) for e, c in enumerate(entries))

            for _ in range(6):
                groups = {}
                for p in points:
                    groups.setdefault(nearest(p)[1], []).append(p)
                for e, group in groups.items():
                    entries[e] = [sum(c) // len(group) for c in zip(*group, strict=True)]
            for i, p in enumerate(points):
                error, e = nearest(p)
                codes[i].append(f"{e:02x}")
                errors[i] += error
            numbers += [str(x) for c in entries for x in c]
        digest = hashlib.sha256(",".join(numbers).encode()).hexdigest()
        out += [(r[0], "".join(c), e, r[2], digest) for r, c, e in zip(own, codes, errors, strict=True)]
    totals = {}
    for r in out:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    return sorted([(i, code, error, totals[label], digest) for i, code, error, label, digest in out], key=str)


def codes(spark, rows):
    return sorted(map(tuple, cover_trees.product_codes(make(spark, rows)).collect()), key=str)


@pytest.fixture
def clusters():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 16))
    vectors = [centers[i % 6] + rng.normal(size=16) * rng.choice([0, 0.02, 0.4]) for i in range(150)]
    return [(900 - 5 * i, [float(np.float32(x)) for x in v], i % 4 or None) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("block", [1, 16 * 40, 1 << 19])
def test_codes_equal_plain_rounds(spark, clusters, block, monkeypatch):
    monkeypatch.setattr(cover_trees, "BLOCK_COMPONENTS", block)
    assert codes(spark, clusters) == brute(clusters)


def test_odd_rows(spark, clusters):
    v = clusters[0][1]
    rows = clusters[:30] + [
        (1, None, 1),
        (2, [*v[:15], None], 1),
        (3, [*v[:15], float("nan")], 1),
        (4, [*v[:15], float("-inf")], 1),
        (5, [0.0] * 16, None),
        (None, v, 1),
        (None, None, None),
        (900, v, 2),
        (900, clusters[1][1], 2),
        (6, [], 1),
        (7, [1.5], 1),
        (8, [-1.5], None),
        (9, [0.25] * 11, 1),
    ]
    assert codes(spark, rows) == brute(rows)


def test_few_equal_and_no_vectors(spark):
    rows = [(i, [0.5] * 8, i % 2) for i in range(40)]
    assert codes(spark, rows) == brute(rows)
    assert codes(spark, rows[:3]) == brute(rows[:3])
    assert codes(spark, []) == []


def test_one_label_over_many_tasks(spark, clusters, monkeypatch):
    rows = [(i, v, 7 if n % 5 else None) for n, (i, v, _) in enumerate(clusters)] + [(3000, clusters[0][1], 8)]
    monkeypatch.setattr(cover_trees, "shuffle_tasks", lambda spark: 5)
    assert codes(spark, rows) == brute(rows)


def test_distances_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 64 bits"):
        codes(spark, [(1, [1e9] * 8, 1)])


@pytest.mark.parametrize("kind", ["spread", "copies", "equal"])
@pytest.mark.parametrize("n, d", [(1, 8), (5, 1), (400, 3), (1500, 8)])
def test_trees_cover_their_points(kind, n, d):
    rng = np.random.default_rng(n)
    points = {
        "spread": rng.integers(-50, 50, (n, d)),
        "copies": np.repeat(rng.integers(-2000, 2000, (n // 10 + 1, d)), 10, axis=0)[:n],
        "equal": np.zeros((n, d), dtype=np.int64),
    }[kind]
    tree = CoverTree.of(points)
    assert sorted(tree.order.tolist()) == list(range(n))
    for i in range(len(tree.start)):
        own = tree.order[tree.start[i] : tree.end[i]]
        away = np.sqrt(((points[own] - points[tree.center[i]]) ** 2).sum(axis=1))
        assert tree.center[i] in own and away.max() <= tree.radius[i] + 1e-9
        below = range(tree.child[i], tree.child[i] + tree.children[i])
        if len(below):
            assert tree.start[below[0]] == tree.start[i] and tree.end[below[-1]] == tree.end[i]
            assert all(tree.end[a] == tree.start[b] for a, b in zip(below, below[1:], strict=False))
            hearts = points[tree.center[list(below)]]
            apart = np.sqrt(((hearts[:, None] - hearts) ** 2).sum(axis=2)) + np.eye(len(hearts)) * 1e9
            assert apart.min() * 2.01 > min(away.max(), tree.radius[i])  # farther apart than the reach below
    ordered = points[tree.order]
    for k in (1, 2, 16):
        entries = points[rng.integers(0, n, k)]
        wanted = np.stack([((ordered - c) ** 2).sum(axis=1) for c in entries], axis=1).argmin(axis=1)
        assert (cover_trees.nearest_entries(tree, ordered, entries) == wanted).all()
        sums = np.zeros((k, d + 1), dtype=np.int64)
        np.add.at(sums, wanted, np.concatenate([ordered, np.ones((n, 1), np.int64)], axis=1))
        assert (cover_trees.round_sums(tree, ordered, entries) == sums).all()


def test_whole_subtrees_are_assigned():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(0, 40, (500, 4)) + 10_000 * i for i in range(4)])
    tree = CoverTree.of(points)
    ordered, entries = points[tree.order], np.array([[10_000 * i] * 4 for i in range(4)])
    compared = [nodes for nodes, nearest in tree.ranges(cover_trees.points_of_centers(tree, ordered), entries) if nearest is None]
    assert not any(len(nodes) for nodes in compared)


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    points = rng.integers(-(2**26), 2**26, (50, 8))
    got = cover_trees.squared_distances(points, points[:4])
    wanted = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c, strict=True)) for c in points[:4]] for p in points]
    assert got.tolist() == wanted
