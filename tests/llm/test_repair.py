import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import repair
from verify import bag

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """(cost, audit) by trying every edit, from the end of the rows backwards."""
    @cache
    def rest(i, state):
        found = []
        if i == len(rows) and state in (repair.START, repair.ASSISTANT):
            found.append((0, ""))
        goal = repair.ASSISTANT if state == repair.USER else repair.USER
        role = "ua"[goal == repair.ASSISTANT]
        if i < len(rows):
            initial, fault = rows[i]
            more = 5 * (fault == repair.TRUNCATED)
            options = [(2, "D", state)]
            if fault < repair.BLANK:
                options += [(more, "K", goal)] * (initial == role) + [(1 + more, "R", goal)]
                options += [(more, "K", repair.SYSTEM)] * (initial == "s" and state == repair.START)
            for cost, edit, to in options:
                c, a = rest(i + 1, to)
                found.append((cost + c, edit + a))
        # At most two insertions between rows: more come back to the same state.
        for n, to in ((1, goal), (2, repair.ASSISTANT if goal == repair.USER else repair.USER)):
            c, a = closed(i, to)
            found.append((5 * n + c, "I" * n + a))
        return min(found)

    @cache
    def closed(i, state):
        """As `rest`, without insertions before the next row."""
        found = [(0, "")] if i == len(rows) and state in (repair.START, repair.ASSISTANT) else []
        goal = repair.ASSISTANT if state == repair.USER else repair.USER
        if i < len(rows):
            initial, fault = rows[i]
            more = 5 * (fault == repair.TRUNCATED)
            options = [(2, "D", state)]
            if fault < repair.BLANK:
                options += [(more, "K", goal)] * (initial == "ua"[goal == repair.ASSISTANT]) + [(1 + more, "R", goal)]
                options += [(more, "K", repair.SYSTEM)] * (initial == "s" and state == repair.START)
            for cost, edit, to in options:
                c, a = rest(i + 1, to)
                found.append((cost + c, edit + a))
        return min(found, default=(10 ** 9, ""))
    return rest(0, repair.START)


def plain(rows):
    """Result columns per conversation, by direct reading of the rules."""
    def key(x):
        return str(x) if x is not None else " "
    out, by = {}, {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        draw = zlib.crc32(f"{key(conv)}:{key(turn)}".encode()) % 20
        own = by.setdefault(conv, [])
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        own += [(turn is not None, turn or 0, role, digest, copy, turn, text) for copy in range(2 if draw == 3 else 1)]
    for conv, own in by.items():
        own.sort(key=lambda r: r[:5])
        seen, faults = set(), []
        for r in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", r[6])
            faults.append(repair.BLANK if not solid else repair.DUPLICATE if (r[2], r[6]) in seen else repair.SOUND if solid[-1] in ".!?" else repair.TRUNCATED)
            seen.add((r[2], r[6]))
        initials = [r[2][:1] for r in own]
        cost, audit = cheapest(tuple(zip(initials, faults, strict=True)))
        lines, rest, state = [], iter(own), "a"
        for edit in audit:
            r = next(rest) if edit != "I" else None
            if edit == "D":
                continue
            state = r[2][0] if edit == "K" else "a" if state == "u" else "u"
            lines.append(f"{r[2] if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{r[6] if r else ''}")
        turns = {r[5] for r in own if r[5] is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in (repair.BLANK, repair.DUPLICATE, repair.TRUNCATED)],
                     sum(a + b not in repair.LEGAL for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


steps = st.lists(st.tuples(st.sampled_from("suax"), st.integers(0, 3)), max_size=9)


@settings(max_examples=300, deadline=None)
@given(steps)
def test_audit_is_the_cheapest_and_least(rows):
    found = repair.ended(repair.from_state(repair.START, rows))
    assert (found[0], found[1].text()) == cheapest(tuple(rows))


@settings(max_examples=100, deadline=None)
@given(steps, st.integers(1, 4))
def test_colliding_hashes_change_nothing(rows, modulus):
    kept, repair._PRIME = repair._PRIME, modulus
    try:
        found = repair.ended(repair.from_state(repair.START, rows))
    finally:
        repair._PRIME = kept
    assert (found[0], found[1].text()) == cheapest(tuple(rows))


@settings(max_examples=200, deadline=None)
@given(st.text("DIKR", max_size=40), st.text("DIKR", max_size=40), st.integers(0, 40))
def test_audits_compare_as_their_texts(a, b, shared):
    root = repair.Audit()
    for edit in a[:shared]:
        root = repair.Audit(edit, root)
    x = y = root
    for edit in a[shared:]:
        x = repair.Audit(edit, x)
    for edit in b:
        y = repair.Audit(edit, y)
    s, t = a, a[:shared] + b
    assert (x.text(), y.text()) == (s, t) and repair.compared(x, y) == (s > t) - (s < t)
    assert x.at(len(s) // 2).text() == s[:len(s) // 2]


@pytest.fixture(scope="module")
def spoiled():
    """Conversations with wrong orders, blanks, copies, cut texts and holes, one of them long, one all of one row."""
    rng = random.Random(4)
    texts = ["Fine.", "Really?", "cut off", "", " \t", "Yes!\n", "né.", "x . "]
    rows = []
    for conv in range(60):
        rows += [(conv, 2 * t if conv % 7 == 0 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), f"{rng.choice(texts)}") for t in range(rng.randint(1, 12))]
    rows += [(1000, t, ("user", "assistant")[(t + (t > 500)) % 2] if rng.random() < 0.9 else "system", f"{t} " + rng.choice(texts[:3]) + rng.choice([".", ""])) for t in range(900)]
    rows += [(1001, 5, "user", "Again.")] * 200
    return rows


@pytest.mark.parametrize("block", [3, 50, 4096])
def test_whole_operator(spark, kept_table, spoiled, block):
    """Long conversations are cut into stretches, by ranges and blocks, and chained again."""
    rows = spoiled if block > 3 else [r for r in spoiled if r[0] != 1000 or r[1] < 120]
    got = repair.audited(spark.createDataFrame(rows, SCHEMA).repartition(5), kept_table, block)
    found = {r[0]: tuple(r)[1:] for r in got.collect()}
    want = plain(rows)
    assert found.keys() == want.keys()
    for conv, expected in want.items():
        assert found[conv] == expected, conv


def test_no_task_holds_a_hot_conversation(spark, kept_table, spoiled):
    rows = spark.createDataFrame([r for r in spoiled if r[0] == 1000], SCHEMA)
    found = kept_table(repair.stretches(repair.faults(repair.damaged(rows)), 100), "test-stretches").where("seq = -1").collect()
    assert len(found) >= 9 and max(r.n for r in found) <= 100 and len({r.part for r in found}) > 1


def test_odd_rows(spark, kept_table):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (7, None, "", "."), (7, 3, "user", None),
            (8, 1, "user", "w. " * 100_000), (8, 2, "assistant", "Yes."), (9, -2 ** 63, "user", "A."), (9, 2 ** 63 - 1, "assistant", "B."),
            (10, 4, "user", "Same."), (10, 4, "user", "Same."), (10, 4, "assistant", "Other.")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "'x' as digest", "2 as fault", "3 as part")
    got = {r[0]: tuple(r)[1:] for r in repair.audited(frame, kept_table).collect()}
    want = plain(rows)
    want[9] = (min(want[9][0], 2 ** 63 - 1), *want[9][1:])
    assert got == want
    assert repair.audited(spark.createDataFrame([], SCHEMA), kept_table).count() == 0


def test_dropped_conversation_stays(spark, kept_table):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.audited(spark.createDataFrame([(conv, 0, "user", "Gone.")], SCHEMA), kept_table).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_sql(spark, kept_table):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    got = repair.audited(spark.read.parquet(f"{sf}/conversations.parquet"), kept_table)
    cur = con.execute(repair.AUDITED_SQL)
    assert bag([d[0] for d in cur.description], cur.fetchall()) == bag(got.columns, [tuple(r) for r in got.collect()])
