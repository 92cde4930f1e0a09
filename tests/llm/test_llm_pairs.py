"""Near-duplicate operators against brute force: embeddings, SimHash, and connected components."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fleetstate.llm import neighbours, simhash
from fleetstate.llm.components import Forest, components

SF_DIR = "/root/testdata/sf0.001"


def least_reachable(near: np.ndarray, names: list) -> list:
    label = np.arange(len(names))
    while True:
        new = np.where(near | np.eye(len(names), dtype=bool), label[None, :], len(names)).min(axis=1)
        if (new == label).all():
            return label.tolist()
        label = new


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 300), (401, 400), (400, 401)]
    rng.shuffle(edges)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_forest_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(2, 60))
        near = rng.random((n, n)) < 0.03
        near |= near.T
        forest = Forest(n)
        for a, b in zip(*np.nonzero(near)):
            forest.link(np.array([a]), np.array([b]))
        assert forest.name.tolist() == least_reachable(near, list(range(n)))


def brute_vectors(rows):
    out = {}
    for i, (vec_id, vector, label) in enumerate(rows):
        out[i] = [0, vec_id]
    usable = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    near = np.zeros((len(rows), len(rows)), dtype=bool)
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                near[i, j] = np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))) >= 0.98
    component = least_reachable(near, rows)
    for i in usable:
        group = [rows[j][0] for j in usable if component[j] == component[i] and rows[j][0] is not None]
        out[i] = [int(near[i].sum()), min(group, default=None)]
    return sorted((rows[i][0] is None, rows[i][0] or 0, *v[:1], v[1] is None, v[1] or 0) for i, v in out.items())


@pytest.mark.parametrize("block", [2048, 16, 3])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(12, 6))
    rows = []
    for i in range(160):
        vector = centres[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=6) * rng.choice([0, 0.05, 0.2])
        rows.append((i, vector.tolist(), int(rng.integers(2))))
    hot = rows[0][1]
    rows += [(1000 + i, hot, rows[0][2]) for i in range(80)]  # a third of all rows is one vector
    rows += [(7, None, 0), (7, [0.0] * 6, 0), (2000, [None] + [1.0] * 5, 0), (2001, [float("nan")] * 6, 0)]
    rows += [(2002, [float("inf")] + [1.0] * 5, 0), (2003, hot, None), (2004, [], 0), (2005, [1.0, 2.0], 0)]
    rows += [(2006, [2.0, 4.0], 0), (None, hot, rows[0][2]), (2007, [-0.0, 1.0], 0), (2008, [0.0, 1.0], 0), rows[3]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, cid string")
    found = neighbours.near_vectors(df).collect()
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id is None, r.component_id or 0) for r in found)
    assert got == brute_vectors(rows)


def test_compared_pairs_in_64_dimensions_are_under_half_of_all(spark, monkeypatch):
    """Pivots pay in many dimensions too, and the cells lose no link."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter("label < 3")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in table.select("vec_id", "embedding", "label").collect()]
    assert len(rows[0][1]) == 64 and len(rows) > 400
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 4)
    pairs, real = [], neighbours._tiles

    def counted(cells):
        tiles = real(cells)
        sides = tiles.groupBy("label", "size", "cell", "one", "two").agg(
            F.count(F.when(F.col("block") == F.col("one"), 1)).alias("a"), F.count(F.when(F.col("block") == F.col("two"), 1)).alias("b")
        )
        pairs.extend(r.a * (r.a - 1) // 2 if r.one == r.two else r.a * r.b for r in sides.collect())
        return tiles

    monkeypatch.setattr(neighbours, "_tiles", counted)
    found = neighbours.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    sizes = collections.Counter(label for *_, label in rows)
    assert sum(pairs) < sum(n * (n - 1) // 2 for n in sizes.values()) / 2
    got = sorted((False, r.vec_id, r.n_links, False, r.component_id) for r in found)
    assert got == brute_vectors(rows)


def test_no_vectors(spark):
    assert neighbours.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_trie_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(25):
        n = int(rng.integers(2, 300))
        base = rng.integers(0, 1 << 64, size=max(1, n // 6), dtype=np.uint64)
        keys = base[rng.integers(0, len(base), n)]
        for _ in range(int(rng.integers(0, 6))):
            keys = keys ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        keys = np.unique(keys)
        near = np.bitwise_count(keys[:, None] ^ keys[None, :]) <= 4
        a, b = simhash.trie_links(keys, 0, 0, 0, 4)
        got = np.arange(len(keys))
        got[a] = b
        assert got.tolist() == least_reachable(near, list(keys))


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def texts():
    rng = random.Random(3)
    base = [" ".join(rng.choice("ab cd ef gh ij kl mn op".split()) for _ in range(rng.randrange(1, 300))) for _ in range(25)]
    out = [None, "", " \n\t ", "One", "ÀB C D E f", "x " * 20_000]
    for text in base:
        out += [text, text.upper(), text + " tail"]
    return out + [base[0]] * 60  # copies


def test_simhash_equals_brute_force(spark):
    rows = [(i, t, "clash") for i, t in enumerate(texts())] + [(None, None, "x"), (3, "One", "repeated")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = simhash.simhash_components(df).collect()
    prints = np.array([brute_fingerprint(t) for _, t, _ in rows], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    group = least_reachable(near, rows)
    expected = []
    for i, (doc_id, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        expected.append((str(doc_id), int(prints[i]), min(ids)))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in found) == sorted(expected)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({e[2] for e in expected})


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_query_has_the_contract_columns(spark):
    found = simhash.op3_simhash_near_dedup(spark, SF_DIR)
    assert found.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert all(len(r.fingerprint) == 16 for r in found.collect())
    assert neighbours.op1_embedding_near_dedup(spark, SF_DIR).columns[:4] == ["vec_id", "n_links", "component_id", "kept"]
