import random
import re

import duckdb
import pytest

from sampletide.llm import substring


def plain(rows, unit, min_words):
    """doc_id -> passages (start, stop) by a pass over all units in order."""
    seen, out = {}, {}
    cut = {"line": r"[^\n]+", "sentence": r"[^.!?\n]+[.!?]*|[.!?]+"}[unit]
    for doc_id, text in sorted(r for r in rows if r[0] is not None):
        run = []

        def close(run=run, doc_id=doc_id):
            if sum(w for _, _, w in run) >= min_words:
                out.setdefault(doc_id, []).append((run[0][0], run[-1][1]))
            run.clear()
        for number, m in enumerate(m for m in re.finditer(cut, text or "") if m.group().split()):
            words = m.group().lower().split()
            if seen.setdefault(" ".join(words), (doc_id, number)) != (doc_id, number):
                run.append((m.start(), m.end(), len(words)))
            else:
                close()
        close()
    return out


def corpus():
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgé", k=4)) for _ in range(300)]
    sentence = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + rng.choice([".", "!", "?"])
    passages, stock = [" ".join(sentence(8) for _ in range(7)) for _ in range(3)], sentence(9)
    rows = []
    for i in range(150):
        parts = [sentence(rng.randint(1, 12)) for _ in range(rng.randint(0, 8))] + [stock] * (i % 3 == 0)
        if i % 5 == 0:
            place = rng.randint(0, len(parts))
            parts.insert(place, rng.choice(["so it runs on ", ""]) + rng.choice([passages[i % 3], passages[i % 3].upper()]) + rng.choice([" and on", ""]))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    return rows, passages


@pytest.mark.parametrize("unit", ["sentence", "line"])
def test_same_as_a_plain_pass(documents, kept_table, unit):
    rows, _ = corpus()
    docs = documents(rows).repartition(6)
    got: dict = {}
    for r in substring.passages(docs, kept_table, unit, 25).orderBy("start").collect():
        got.setdefault(r.doc_id, []).append((r.start, r.stop))
    want = plain(rows, unit, 25)
    assert got == want
    texts = {r.doc_id: r for r in substring.without_passages(docs, kept_table, unit, 25).collect()}
    for doc_id, text in rows:
        out, at = [], 0
        for a, b in want.get(doc_id, []):
            out.append(text[at:a])
            at = b
        assert texts[doc_id].text == "".join(out) + text[at:]
        assert [tuple(s) for s in texts[doc_id].removed] == want.get(doc_id, [])


def test_passages_inside_lines_are_caught_and_stock_phrases_left(documents, kept_table):
    rows, _ = corpus()
    found = {r.doc_id for r in substring.passages(documents(rows), kept_table).collect()}
    assert found == {i for i in range(150) if i % 5 == 0} - {0, 5, 10}


def test_sql(documents, kept_table):
    docs = documents(corpus()[0])
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert sorted(map(tuple, substring.passages(docs, kept_table).collect()), key=str) == sorted(con.execute(substring.PASSAGES_SQL).fetchall(), key=str)


def test_paragraphs():
    assert [(n, s, e) for n, s, e, _ in substring.units("a b\nc\n\n d\n\n\n\ne", "paragraph")] == [(0, 0, 5), (1, 7, 9), (2, 13, 14)]


def test_odd_rows(odd, no_documents, kept_table):
    assert substring.passages(no_documents, kept_table).count() == 0
    # Rows of one id are one document; rows without an id take no part.
    assert substring.passages(odd, kept_table, min_words=1).count() == 0
    cut = substring.without_passages(odd, kept_table)
    assert cut.columns == [*odd.columns, "removed"] and cut.count() == 9
