import duckdb
import pytest

from sampletide.llm import mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target, left = sum(sizes.values()), {}, dict(sizes)
    while left:
        level = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if level * weight[s] > 3 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in left}
        target |= {s: 3.0 * sizes[s] for s in over}
        left = {s: v for s, v in left.items() if s not in over}
    return target


def test_targets_and_nearness(documents, kept_table):
    rows = [(i, "w " * (1 + i * 37 % 101), "en", [None, "b", "a", "Z", "é", "tiny"][i % 6 if i % 50 else 5]) for i in range(3000) if i % 6 < 5 or i % 100 == 5]
    got = mixing.taken(documents(rows), kept_table).collect()
    assert len(got) == len(rows)
    size, source = {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[3] for r in rows}
    total = {s: sum(size[i] for i in size if source[i] == s) for s in set(source.values())}
    want = plain_targets(total)
    assert sum(want.values()) == pytest.approx(sum(total.values()))
    taken = dict.fromkeys(total, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(want[s])
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    for s in total:
        assert taken[s] == pytest.approx(want[s], rel=0.02)
    again = mixing.taken(documents(rows[::-1]).repartition(5), kept_table).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_rows_taken(documents, kept_table):
    docs = documents([(i, "x " * (i % 9), "en", "ab"[i % 2]) for i in range(500)])
    copies = {r.doc_id: r.copies for r in mixing.taken(docs, kept_table).collect() if r.copies}
    mixed = mixing.mix(docs, kept_table)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies


def test_sql_on_odd_rows(odd, no_documents, kept_table):
    got = mixing.taken(odd, kept_table)
    con = duckdb.connect()
    con.register("documents", odd.select("doc_id", "text", "source").toArrow())
    want = con.execute(mixing.TAKEN_SQL).fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert mixing.taken(no_documents, kept_table).count() == 0
    assert mixing.mix(no_documents, kept_table).count() == 0
    assert mixing.mix(odd, kept_table).columns == odd.columns
