import random

import numpy as np
import pytest

from sampletide.llm import components, minhash
from sampletide.llm.components import Sets, connected


def plain(rows, size, percent):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {rows[i][0]: (len(sets[i]), rows[top(i)][0]) for i in range(len(rows))}


def corpus(seed, n):
    """Copies, near copies of all grades, a hot passage, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    base, passage, rows = [[word() for _ in range(rng.choice([3, 5, 20, 60]))] for _ in range(12)], [word() for _ in range(15)], []
    for i in range(n):
        words = list(rng.choice(base)) if i % 2 else [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5]) if words else 0):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join((passage if i % 3 == 0 else []) + words).replace("a", rng.choice("aA"))))
    return rows


@pytest.mark.parametrize(("size", "block"), [(4, 512), (5, 16)])
def test_same_as_all_pairs(documents, kept_table, monkeypatch, size, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = corpus(size, 500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(rows).repartition(5), kept_table, size=size).collect()}
    assert got == plain(rows, size, 80)


def test_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(8)
    shared, rest = rng.integers(0, 1 << 63, (2, 80_000), dtype=np.uint64)
    matches = []
    for i in range(400):
        own = np.concatenate([shared[i * 200:i * 200 + 80], rest[i * 200:i * 200 + 20]])
        other = shared[i * 200:i * 200 + 80]
        matches.append((minhash.signature(own) == minhash.signature(other)).sum())
    assert abs(np.mean(matches) / minhash.COORDINATES - 0.8) < 0.015
    assert min(matches) >= minhash.MATCHES


def test_intersections():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[12:]] for a in sets[:12]]
    assert minhash.intersections(sets[:12], sets[12:], width=7).tolist() == want


@pytest.mark.parametrize("hot", [1000, 1_000_000])
def test_components(spark, kept_table, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT_NODES", hot)
    rng = random.Random(10)
    links = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1400)] + [(i, i + 1) for i in range(5000, 5200)] + [(9000, 9000 + i) for i in range(1, 2500)] + [(20_000, 12_000 + i) for i in range(1, 2500)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long"), kept_table).collect()}
    sets = Sets(20_001)
    for a, b in links:
        sets.join(a, b)
    assert got == {i: int(r) for i, r in enumerate(sets.roots()) if r != i}
    assert connected(spark.createDataFrame([], "a long, b long"), kept_table).count() == 0


def test_odd_rows(odd, no_documents, kept_table):
    rows = minhash.near_duplicates(odd, kept_table, size=4).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=str) == sorted(
        [(1, 1, True), (2, 2, True), (3, 3, True), (None, 5, False), (5, 5, True), (5, 5, True), (6, 6, True), (None, None, True), (7, 7, True)], key=str)
    assert minhash.near_duplicates(no_documents, kept_table).count() == 0
    kept = minhash.without_near_duplicates(odd, kept_table)
    assert kept.columns == odd.columns


def test_one_row_of_a_component_stays(odd, documents, kept_table):
    kept = minhash.without_near_duplicates(odd, kept_table).collect()
    # Of the copies (None, 5, 5) one with the id stays; rows without words and others all stay.
    assert sorted((r.doc_id for r in kept), key=str) == [1, 2, 3, 5, 6, 7, None]
    assert [r.doc_id for r in kept if r.text == "one two three four five six"] == [5]
    long, other = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    # Copies and a near copy without ids; a near copy that shares its id with a clean document.
    rows = [(None, long), (None, long), (None, long + " z"), (1, other), (2, other + " z"), (2, "a clean document of its own")]
    kept = minhash.without_near_duplicates(documents(rows).repartition(3), kept_table).collect()
    assert sorted(((r.doc_id, r.text[:2]) for r in kept), key=str) == [(1, "b0"), (2, "a "), (None, "a0")]
