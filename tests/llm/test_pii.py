import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import pii

PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda d, s: 16 <= len(d) <= 19 and pii.luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, s: 8 <= len(d) <= 15),
}


def plain(text):
    """The base by the contract's patterns as they stand."""
    return [(n, m.start(), m.end()) for n, (p, fine) in PATTERNS.items() for m in re.finditer(p, text or "")
            if fine(re.sub("[^0-9]", "", m.group()), m.group())]


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab9014@.-+_% ()é\n"), max_size=60))
def test_base_is_what_the_patterns_find(text):
    assert [(pii.KINDS[k], s, e) for k, s, e in sorted(pii.base(text))] == plain(text)


@pytest.mark.parametrize("text", ["a@b.c+x@d.e", "a@@b.c", "x@y.z.", "1.2.3.4.5.6.7.8.9", "300.1.1.1.2.2.2.2", "4111 1111 1111 1111",
                                  "4111-1111-1111-1112", "+1 (555) 123-4567 +12", "é a@b.co", "001.02.3.4", "+1234567890123456"])
def test_base_edges(text):
    assert [(pii.KINDS[k], s, e) for k, s, e in sorted(pii.base(text))] == plain(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1((" * 75_000, "1 " * 150_000):
        pii.candidates(text)


def test_number_holds_votes_and_shapes():
    number = np.array([pii.described("call +1 (555) 123-4567", 3, 5, 22, True)])
    votes, shapes = pii.unpacked(number)
    assert votes.tolist() == [[1, 1, 1, 1, 0]] and shapes[0, 0] == 1
    assert number[0] < pii.PATTERNS


def test_reliabilities_follow_the_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = [0.95, 0.9, 0.85, 0.55, 0.5]
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) for r in right], 1)
    votes = np.where(votes, 1, 2)
    rows, count = np.unique(votes, axis=0, return_counts=True)
    post, table = pii.expectation_maximisation(rows, count.astype(float))
    found = {tuple(r): p for r, p in zip(rows, post, strict=True)}
    assert np.mean([(found[tuple(v)] > 0.5) == t for v, t in zip(votes, truth, strict=True)]) > 0.94
    assert table[1, 0, 1] > 0.9 > 0.7 > table[1, 4, 1]


def test_classifier_adds_what_labelers_agree_on(documents, kept_table):
    good = [(i, f"please email john.doe{i} [at] example [dot] com or call +1 (555) 123-45{i:02d} at once") for i in range(60)]
    rows = {r.doc_id: r for r in pii.find(documents(good), kept_table).collect()}
    for i, text in good:
        spans = rows[i].spans.split(",")
        assert {f"{k}:{s}:{e}" for k, s, e in plain(text)} <= set(spans)
        assert rows[i].base_sha256 == sha(plain(text)) and rows[i].n_phone == 1 and rows[i].n_email == 0
        assert any(s.startswith("email:13:") for s in spans)


def test_odd_rows(odd, no_documents, kept_table):
    rows = pii.find(odd, kept_table).collect()
    assert len(rows) == 9
    assert sorted((r.n_email, r.n_phone) for r in rows)[-1] == (1, 1)
    assert {r.base_sha256 for r in rows if not r.spans} == {sha([])}
    assert pii.find(no_documents, kept_table).count() == 0
    redacted = pii.redact(odd)
    assert redacted.columns == odd.columns
    texts = [r.text for r in redacted.collect()]
    assert "mail <email> or <phone> now" in texts and texts.count(None) == 2
    assert pii.redact(no_documents).count() == 0
