import numpy as np
import pytest

from sampletide.llm import embed

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(ids, rows, cosine=0.95):
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    root = np.arange(len(ids))
    while True:
        new = np.array([min(root[i], root[linked[i]].min(initial=root[i])) for i in range(len(ids))])
        if (new == root).all():
            return linked.sum(1), ids[root]
        root = new


@pytest.mark.parametrize(("spread", "block"), [(0.0, 64), (0.03, 64), (0.045, 8192)])
def test_same_as_all_pairs(spark, kept_table, monkeypatch, spread, block):
    monkeypatch.setattr(embed, "BLOCK", block)
    monkeypatch.setattr(embed, "CELL", 100)
    rng = np.random.default_rng(7)
    hot = rng.normal(size=32)
    rows = np.vstack([hot / np.linalg.norm(hot) + rng.normal(size=(400, 32)) * spread, rng.normal(size=(300, 32)),
                      np.repeat(rng.normal(size=(50, 32)), 2, 0) + rng.normal(size=(100, 32)) * 0.2]).astype(np.float32)
    ids = rng.permutation(len(rows)).astype(np.int64)
    order = np.argsort(ids)
    table = spark.createDataFrame([(int(i), r.tolist(), 0) for i, r in zip(ids, rows, strict=True)], SCHEMA).repartition(5)
    got = {r.vec_id: r for r in embed.near_duplicates(table, kept_table).collect()}
    links, component = plain(ids[order], rows[order].astype(float))
    assert [(got[i].n_links, got[i].component_id, got[i].kept) for i in range(len(ids))] == [
        (int(n), int(c), int(c) == i) for i, (n, c) in enumerate(zip(links, component, strict=True))]


def test_close_calls_are_settled_in_double(spark, kept_table):
    angle = np.arccos(0.95)
    rows = [(i, [1.0, 0.0] if i == 0 else [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate([0, angle - 2e-5, angle + 2e-5, -angle + 2e-5])]
    table = spark.createDataFrame([(i, r, 0) for i, r in rows], "vec_id long, embedding array<double>, label int")
    assert {r.vec_id: r.n_links for r in embed.near_duplicates(table, kept_table).collect()} == {0: 2, 1: 2, 2: 1, 3: 1}


def test_odd_rows(spark, kept_table):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0),
            (7, [1.0, 1.0], 0), (8, [2.0, 2.0], None), (None, [1.0, 1.0], 0), (9, [1.0, 1.0, 1.0], 0), (7, [1.0, 1.0], 0), (10, [3e38, 3e38], 1), (11, [1e-38, 1e-38], 1)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", home string, n_links int")
    got = sorted(map(tuple, embed.near_duplicates(table, kept_table).collect()), key=str)
    assert sorted(got, key=str) == sorted(
        [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9)] + [(7, 3, 7, True)] * 2 + [(i, 3, 7, False) for i in (8, 10, 11)] + [(None, 0, None, False)], key=str)
    assert embed.near_duplicates(spark.createDataFrame([], SCHEMA), kept_table).count() == 0


def test_ids_with_several_vectors(spark, kept_table):
    """No vector of an id is lost, and an id counts once however many of its vectors are linked."""
    rows = [(1, [1.0, 0, 0]), (1, [0, 1.0, 0]), (2, [1.0, 0, 0]), (3, [0, 1.0, 0])]
    table = spark.createDataFrame([(i, [float(x) for x in r], 0) for i, r in rows], SCHEMA)
    assert {r.vec_id: (r.n_links, r.component_id) for r in embed.near_duplicates(table, kept_table).collect()} == {1: (2, 1), 2: (1, 1), 3: (1, 1)}


def test_several_vectors_and_copies_against_all_pairs(spark, kept_table):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    rows = []
    for i in range(300):
        for _ in range(1 + (i % 9 == 0) * 2):
            exact = rng.random() < 0.4
            rows.append((i, (base[rng.integers(12)] + (0 if exact else 1) * rng.normal(size=16) * 0.12).astype(np.float32)))
    rows += rows[:20]
    unit = np.array([r / np.linalg.norm(r) for _, r in rows], float)
    ids = np.array([i for i, _ in rows])
    near = unit @ unit.T >= 0.95
    links = {i: {int(x) for x in ids[near[ids == i].any(0)]} - {i} for i in range(300)}
    root = {i: i for i in links}
    while (new := {i: min([root[i], *(root[j] for j in links[i])]) for i in links}) != root:
        root = new
    table = spark.createDataFrame([(int(i), r.tolist(), 0) for i, r in rows], SCHEMA).repartition(4)
    got = embed.near_duplicates(table, kept_table).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (len(links[i]), root[i], root[i] == i) for i in links}
