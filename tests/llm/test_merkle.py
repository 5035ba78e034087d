import hashlib
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import merkle
from verify import bag


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def rounds(nodes):
    """All levels of a tree over `nodes`, the last one of a single node."""
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, at):
    """(left, right) of the path from node `at` up."""
    found = []
    for level in levels[:-1]:
        run = at // 8 * 8
        found.append(("".join(level[run:at]), "".join(level[at + 1:run + 8])))
        at //= 8
    return found


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row (doc_id, text, lang, source, n_chars)."""
    by = {}
    for doc_id, text, lang, source, n in rows:
        changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        other = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = leaf_of((doc_id, source, lang, n, text))
        by.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, leaf_of((doc_id, source, lang, n, other if changed else text))))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = [rounds(r[2] for r in sorted(by[x])) for x in langs]
    top = rounds(t[-1][0] for t in trees)
    for i, lang in enumerate(langs):
        for at, (_, _, leaf, doc_id, start) in enumerate(sorted(by[lang])):
            proof = siblings(trees[i], at) + siblings(top, i)
            for left, right in proof:
                start = sha(left + start + right)
            yield doc_id, leaf, trees[i][-1][0], top[-1][0], sha("".join(a + b for a, b in proof)), start, start == top[-1][0]


def results(frame):
    return sorted((tuple(r)[:7] for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (7, 1), (8, 9), (65, 3, 1), (4096, 2), (4097, 513, 8)])
def test_against_plain_trees(documents, kept_table, sizes):
    """Lone leaves, full and broken runs, one block and one row more."""
    rng = random.Random(len(sizes))
    rows = [(0, f"Text {rng.random()} ÀB", lang, "s") for lang, n in zip(("en", None, "é", "de"), sizes, strict=False) for _ in range(n)]
    ids = rng.sample(range(10 ** 6), len(rows))
    rows = [(i, *r[1:]) for i, r in zip(ids, rows, strict=True)]
    frame = documents(rows)
    assert results(merkle.verified(frame.repartition(5), kept_table)) == sorted(plain([tuple(r) for r in frame.collect()]), key=repr)


def test_two_rounds(documents, kept_table, monkeypatch):
    """Blocks of one level: every level is delivered through an exchange."""
    monkeypatch.setattr(merkle, "DEEP", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    frame = documents([(i, f"T {i}", ("en", "de", None)[i % 7 % 3]) for i in range(700)])
    assert results(merkle.verified(frame, kept_table)) == sorted(plain([tuple(r) for r in frame.collect()]), key=repr)


def test_many_languages(documents, kept_table):
    frame = documents([(i, f"T {i}", f"l{i % 300}") for i in range(900)])
    assert results(merkle.verified(frame, kept_table)) == sorted(plain([tuple(r) for r in frame.collect()]), key=repr)


def test_proofs_hold_and_manifest(documents, kept_table):
    frame = documents([(i, f"Doc {i}", "en" if i % 3 else "de") for i in range(90)])
    tree = merkle.Tree(frame, kept_table)
    manifest = {r.lang: r for r in tree.manifest().collect()}
    assert {k: r.n_documents for k, r in manifest.items()} == {"en": 60, "de": 30}
    for r in tree.proofs(full=True).collect():
        proof = [x.split("|") for x in r.proof.split(",")]
        assert r.subroot == manifest[r.lang].subroot and r.root == manifest[r.lang].root == tree.root
        assert merkle.folded(r.leaf, proof) == tree.root
        # Lower-casing the D of a text is noticed.
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0)


def test_odd_rows(odd, no_documents, kept_table):
    want = sorted(plain([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd.collect()]), key=repr)
    assert results(merkle.verified(odd, kept_table)) == want
    assert merkle.verified(no_documents, kept_table).collect() == []
    assert merkle.Tree(no_documents, kept_table).root is None


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 600))
def test_block(n):
    nodes = [sha(str(i)) for i in range(n)]
    levels = rounds(nodes)
    depth = merkle.levels(n)
    top, children = merkle.swept(nodes, depth)
    found = merkle.suffixes(children, depth)
    assert top == levels[-1][0] and len(levels) == depth + 1
    for at in {0, n // 2, n - 1}:
        assert merkle.unrolled(found[at], "") == siblings(levels, at)


def test_sql(spark, kept_table):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = merkle.verified(spark.read.parquet(f"{sf}/documents.parquet"), kept_table)
    cur = con.execute(merkle.VERIFIED_SQL)
    assert bag([d[0] for d in cur.description], cur.fetchall()) == bag(got.columns, [tuple(r) for r in got.collect()])
