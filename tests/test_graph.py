import random

import pytest
from pyspark.sql import functions as F

from sampletide.operators import closure, funnel, ranges
from sampletide.sources.bounds import literal


def walked(edges, start, upward=True):
    """{node: steps} by breadth-first search."""
    follow = {}
    for child, parent in edges:
        a, b = (child, parent) if upward else (parent, child)
        follow.setdefault(a, set()).add(b)
    found, front, steps = {}, {start}, 0
    while front:
        steps += 1
        front = {b for a in front for b in follow.get(a, ()) if b not in found}
        found.update(dict.fromkeys(front, steps))
    return found


@pytest.fixture(scope="module")
def graph(spark):
    """Random edges with cycles, repetitions, a self-loop, nulls and a hub that most ids have for a parent."""
    rng = random.Random(3)
    edges = [(f"n{rng.randint(0, 60):02}", f"n{rng.randint(0, 60):02}") for _ in range(90)]
    edges += [(f"n{i:02}", "n99") for i in range(50)] + [("n99", f"m{i:02}") for i in range(40)] + [("n07", "n07")] + edges[:5]
    frame = spark.createDataFrame([*edges, (None, "n01"), ("n02", None)], "child_lid string, parent_lid string")
    return edges, frame


@pytest.mark.parametrize("most", [7, 100_000])
@pytest.mark.parametrize("upward", [True, False])
def test_reached(spark, graph, most, upward):
    """With `most` of 7 the hub's edges lie in several slots; the result is the same."""
    edges, frame = graph
    starts = sorted({a for e in edges for a in e}) + ["lonely"]
    ids = spark.createDataFrame([(s,) for s in [*starts, "n03", None]], "lid string")
    got = {(r.lid, r.reached_lid): r.steps for r in closure.reached(frame, ids, upward, most).collect()}
    assert got == {(s, n): k for s in starts for n, k in walked(edges, s, upward).items()}


def test_hot_edges_lie_in_slots(graph):
    dealt, hot = closure._dealt(graph[1], "child_lid", "parent_lid", 7)
    assert {r.at for r in hot.collect()} >= {"n99"}
    slots = {r.slot: r.n for r in dealt.where("at = 'n99'").groupBy("slot").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert len(slots) > 3 and max(slots.values()) < 40


def test_roots_and_nothing(spark, graph):
    edges, frame = graph
    parents = {a for a, _ in edges}
    ids = spark.createDataFrame([("n05",), ("n99",)], "lid string")
    got = {(r.lid, r.root_lid) for r in closure.roots(frame, ids).collect()}
    assert got == {(s, n) for s in ("n05", "n99") for n in walked(edges, s) if n not in parents}
    assert closure.ancestors(frame, ids.limit(0)).collect() == []
    assert closure.ancestors(frame.limit(0), ids).collect() == []


@pytest.mark.parametrize("most", [7, 100_000])
@pytest.mark.parametrize("upward", [True, False])
@pytest.mark.parametrize("near", [[], ["substr(lid, 3, 1)", "reverse(lid)"]])
def test_totals(spark, graph, most, upward, near):
    """Counts and ends of what is reached, whatever the order of the numbers."""
    edges, frame = graph
    starts = sorted({a for e in edges for a in e}) + ["lonely"]
    ids = spark.createDataFrame([(s,) for s in [*starts, "n03", None]], "lid string")
    want = {}
    for s in starts:
        for n, k in walked(edges, s, upward).items():
            want.setdefault((s, k), []).append(n)
    got = {(r.lid, r.steps): (r.n, r["first"], r["last"]) for r in closure.totals(frame, ids, upward, near, most=most).collect()}
    assert got == {key: (len(held), min(held), max(held)) for key, held in want.items()}


def test_totals_of_roots_and_nothing(spark, graph):
    edges, frame = graph
    parents = {a for a, _ in edges}
    ids = spark.createDataFrame([("n05",), ("n99",)], "lid string")
    got = {(r.lid, r.steps): r.n for r in closure.totals(frame, ids, only_roots=True).collect()}
    want = [(s, k) for s in ("n05", "n99") for n, k in walked(edges, s).items() if n not in parents]
    assert got == {key: want.count(key) for key in want}
    assert closure.totals(frame, ids.limit(0)).collect() == []
    assert closure.totals(frame.limit(0), ids).collect() == []


def test_sets_are_words(spark):
    """Ids reached together are a word, not a row each: 50 parents of 40 records, reached again by 40 more."""
    pairs = [(f"b{i:02}", f"a{j:02}") for i in range(40) for j in range(50)] + [(f"c{i:02}", f"b{i:02}") for i in range(40)]
    edges = spark.createDataFrame(pairs, "child_lid string, parent_lid string")
    number = {n: i for i, n in enumerate(sorted({x for p in pairs for x in p}))}
    links = spark.createDataFrame([(number[c], number[p], number[p] // closure.BITS, number[p] % closure.BITS) for c, p in pairs], "at long, to long, word long, bit int")
    assert sum(t.count() for t in closure._exact(links, 100_000)) <= 40 * 3
    assert closure.totals(edges, edges.select(F.col("child_lid").alias("lid"))).where("steps = 2").agg(F.sum("n")).first()[0] == 40 * 50


@pytest.mark.parametrize("upward", [True, False])
def test_totals_by_words(spark, graph, upward):
    """Without a core that tasks may hold, sets of words give the same."""
    edges, frame = graph
    starts = sorted({a for e in edges for a in e})
    want = {}
    for s in starts:
        for n, k in walked(edges, s, upward).items():
            want.setdefault((s, k), []).append(n)
    ids = spark.createDataFrame([(s,) for s in starts], "lid string")
    got = {(r.lid, r.steps): (r.n, r["first"], r["last"]) for r in closure.totals(frame, ids, upward, core=0, most=7).collect()}
    assert got == {key: (len(held), min(held), max(held)) for key, held in want.items()}


@pytest.fixture(scope="module")
def made():
    """Records of parts and, some, of their makers; parts of makers, a few of nothing; makers of makers, with a cycle, and one of two others."""
    rng = random.Random(5)
    pairs = [(f"r{rng.randint(0, 60):02}", f"p{rng.randint(0, 19):02}") for _ in range(150)] + [(f"r{i:02}", f"s{i:02}") for i in range(0, 30, 7)]
    pairs += [(f"p{rng.randint(0, 16):02}", f"s{rng.randint(0, 29):02}") for _ in range(60)]
    return pairs + [(f"s{i:02}", f"s{i // 2 if i > 1 else 3:02}") for i in range(1, 30)] + [("s05", "s09")]


@pytest.mark.parametrize("block", [20, 250_000])
@pytest.mark.parametrize("upward", [True, False])
def test_totals_of_few_parents_hold_no_sets(spark, made, monkeypatch, upward, block):
    """Blocks of ids are walked through the core; no set of an id is made, in one block or many."""
    monkeypatch.setattr(closure, "_exact", None)
    monkeypatch.setattr(funnel.totals, "__defaults__", (*funnel.totals.__defaults__[:-1], block))
    starts = sorted({a for e in made for a in e}) + ["lonely"]
    ids = spark.createDataFrame([(s,) for s in [*starts, "r03", None]], "lid string")
    frame = spark.createDataFrame([*made, *made[:9], (None, "s01"), ("r02", None)], "child_lid string, parent_lid string")
    want = {}
    for s in starts:
        for n, k in walked(made, s, upward).items():
            want.setdefault((s, k), []).append(n)
    found = closure.totals(frame, ids, upward, ["reverse(lid)"])
    got = [(r.lid, r.steps, r.n, r["first"], r["last"]) for r in found.collect()]
    assert sorted(got) == sorted((*key, len(held), min(held), max(held)) for key, held in want.items())
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("lid", "string"), ("steps", "int"), ("n", "bigint"), ("first", "string"), ("last", "string")]


def test_totals_of_few_starts_and_roots(spark, made):
    parents, starts = {a for a, _ in made}, ["r01", "r07", "p03", "p18", "s29"]
    ids = spark.createDataFrame([(s,) for s in starts], "lid string")
    frame = spark.createDataFrame(made, "child_lid string, parent_lid string")
    for upward, only_roots in ((True, True), (True, False), (False, False)):
        want = {}
        for s in starts:
            for n, k in walked(made, s, upward).items():
                if not only_roots or n not in parents:
                    want.setdefault((s, k), []).append(n)
        got = [(r.lid, r.steps, r.n, r["first"], r["last"]) for r in funnel.totals(frame, ids, upward, None, only_roots, block=30).collect()]
        assert sorted(got) == sorted((*key, len(held), min(held), max(held)) for key, held in want.items())


def test_block_is_walked_in_parts(made, monkeypatch):
    """What a task does with a block: few pairs and few counts at a time give what all at once give."""
    names = sorted({n for e in made for n in e if n[0] == "s"})
    place = {n: i for i, n in enumerate(names)}
    kin = {a: sorted({place[b] for x, b in made if x == a}) for a in sorted({a for a, _ in made if a[0] != "r"})}
    own = [a for a in kin if a in place]
    lists = funnel.pa.list_(funnel.pa.int32())
    core = dict(told=funnel.pa.table({"lid": names, "told": [True] * len(names)}),
                own=funnel.pa.table({"place": funnel.pa.array([place[a] for a in own], funnel.pa.int32()), "kin": funnel.pa.array([kin[a] for a in own], lists)}))
    rows = [(0, a, b, None) for a, b in made if a[0] == "r"] + [(k, a, None, c) for k in (1, 2) for a, c in kin.items()]
    for upward in (True, False):
        rows_of = rows + [(3, a, None, None) for a in sorted({a for e in made for a in e if upward or a[0] == "p"})]
        block = funnel.pa.table({"kind": [r[0] for r in rows_of], "at": [r[1] for r in rows_of], "to": funnel.pa.array([r[2] for r in rows_of], funnel.pa.string()),
                                 "kin": funnel.pa.array([r[3] for r in rows_of], lists)})
        results = []
        for pairs, counts in ((16_000_000, 2_000_000), (70, 5)):
            monkeypatch.setattr(funnel, "PAIRS", pairs)
            monkeypatch.setattr(funnel, "COUNTS", counts)
            results.append(sorted(tuple(r.values()) for b in funnel._counted(block, **funnel._core(**core, upward=upward, only_roots=False)) for r in b.to_pylist()))
        want = {}
        for s in sorted({a for e in made for a in e}):
            for n, k in walked(made, s, upward).items():
                want.setdefault((s, k), []).append(n)
        assert results[0] == results[1] == sorted((*key, len(held), min(held), max(held)) for key, held in want.items() if upward or key[0][0] != "r")


def test_large_core_and_hot_ids_are_left(spark, made):
    """A core that tasks may not hold, and an id whose edges fill blocks, are for the sets of words."""
    frame = spark.createDataFrame(made, "child_lid string, parent_lid string")
    ids = frame.select(F.col("child_lid").alias("lid"))
    assert funnel.totals(frame, ids, core=20) is None
    hot = spark.createDataFrame([("r00", f"p{i:03}") for i in range(500)], frame.schema)
    assert funnel.totals(frame.unionByName(hot), ids, block=50) is None


@pytest.fixture(scope="module")
def ids():
    """Ids that share prefixes of every length, and one that occurs often."""
    rng = random.Random(8)
    made = []
    for _ in range(150):
        digits = f"{rng.choice([1, 2, 1 << 40]):012x}{rng.choice('123')}{rng.randint(0, 1):02x}0{rng.choice([1, 2, 65535]):04x}{rng.choice('01')}{rng.randint(0, 3):03x}{rng.randint(0, 2 ** 20):08x}"
        made.append(f"{digits[:8]}-{digits[8:12]}-{digits[12:16]}-{digits[16:20]}-{digits[20:]}")
    return made + made[:1] * 60


@pytest.mark.parametrize("most", [5, 200_000])
def test_within(spark, ids, most):
    rng = random.Random(9)
    ends = [tuple(sorted(rng.sample(ids, 2))) for _ in range(60)] + [(i, i) for i in ids[:5]] + [(ids[3][:-1] + "0", ids[3][:-1] + "f")]
    ends += [("00000000-0000-0000-0000-000000000000", "ffffffff-ffff-ffff-ffff-ffffffffffff"), (max(ids), min(ids)), (None, ids[0]), (ids[0], None)]
    frame = spark.createDataFrame([(n, *e) for n, e in enumerate(ends)], "name int, lid_lo string, lid_hi string")
    records = spark.createDataFrame([*enumerate(ids), (-1, None)], "level int, lid string")
    joined = ranges.within(records, frame, most=most)
    got = sorted((r.name, r.level) for r in joined.collect())
    assert got == sorted((n, i) for n, (lo, hi) in enumerate(ends) if lo and hi for i, x in enumerate(ids) if lo <= x <= hi)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("part_rows", [20, 200_000])
def test_totals_of_ranges(spark, ids, part_rows):
    """Counts and sums of overlapping ranges, with ends that are no ids, an id that occurs often, values that are null."""
    rng = random.Random(9)
    ends = [tuple(sorted(rng.sample(ids, 2))) for _ in range(60)] + [(i, i) for i in ids[:5]] + [(ids[3][:-1] + "0", ids[3][:-1] + "f")]
    ends += [("0", "1"), ("00000000-0000-0000-0000-000000000000", "ffffffff-ffff-ffff-ffff-ffffffffffff"), (max(ids), min(ids)), (None, ids[0]), (ids[0], None)]
    frame = spark.createDataFrame([(n, *e) for n, e in enumerate(ends)], "name int, lid_lo string, lid_hi string")
    values = [(None if n % 4 == 0 else n * 10 ** 15 - 10 ** 17, i) for n, i in enumerate(ids)]
    records = spark.createDataFrame([*values, (5, None)], "value long, lid string")
    found = ranges.totals(records, frame, {"total": "value"}, part_rows=part_rows)
    got = {r.name: (r.n_records, r.total) for r in found.collect()}
    want = {}
    for n, (lo, hi) in enumerate(ends):
        inside = [v for v, i in values if lo and hi and lo <= i <= hi]
        if inside:
            told = [v for v in inside if v is not None]
            want[n] = len(inside), sum(told) if told else None
    assert got == want and found.columns == ["name", "lid_lo", "lid_hi", "n_records", "total"]


def test_pieces_are_few(spark):
    lo, hi = "018c0000-0000-2010-0001-000000000000", "018c0000-0001-2010-0001-000000000000"
    frame = literal(spark, [("018c" + lo[4:], hi)], "lid_lo string, lid_hi string")
    assert ranges.pieces(frame).count() <= 2 * len(ranges.LENGTHS)
    assert ranges.within(literal(spark, [(lo,)], "lid string"), frame.limit(0)).count() == 0
