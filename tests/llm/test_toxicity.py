import random
import zlib
from collections import Counter

import numpy as np

from sampletide.llm import toxicity

INSULTS = ["blorx", "snarg", "grubb"]


def corpus(n, seed=11):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 200))
        toxic = i % 6 == 0
        for _ in range(rng.randint(1, 3) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(INSULTS)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(documents, labels, kept_table):
    rows, known = corpus(3000)
    got = {r.doc_id: r for r in toxicity.score(documents(rows), labels(known[:2500]), kept_table).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    unseen = [i for i in got if got[i].held_out or i >= 2500]
    assert np.mean([got[i].predicted == (i % 6 == 0) for i in unseen]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    # One insult in a long text counts as much as in a short one.
    model = toxicity.learn(documents(rows), labels(known), kept_table)
    clean = rows[1][1] + " " + rows[2][1]
    assert model.score(model.evidence(clean * 30 + " blorx " + clean * 30)) > 0.5 > model.score(model.evidence(clean * 60))
    kept = toxicity.without_toxic(documents(rows), labels(known), kept_table)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in toxicity_by_id(documents, labels, kept_table, rows, known).items() if not r.predicted}


def toxicity_by_id(documents, labels, kept_table, rows, known):
    return {r.doc_id: r for r in toxicity.score(documents(rows), labels(known), kept_table).collect()}


def test_held_out_labels_are_not_learned(documents, labels, kept_table):
    rows, known = corpus(1500)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in known]
    one = toxicity.score(documents(rows), labels(known), kept_table).collect()
    two = toxicity.score(documents(rows), labels(turned), kept_table).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def plain_model(texts, every):
    """Kneser-Ney by definition: p(word | before) of a class from its texts and the texts of all documents."""
    pairs, shared = Counter(), Counter(w for t in every for w in t)
    for t in texts:
        pairs.update(zip(t, t[1:]))
    follows = Counter(b for _, b in pairs)
    freed = 1 - sum(max(n - toxicity.WORD_DISCOUNT, 0) for n in follows.values()) / max(len(pairs), 1)
    size = sum(shared.values()) + len(shared) + 1

    def single(word):
        return max(follows[word] - toxicity.WORD_DISCOUNT, 0) / max(len(pairs), 1) + freed * (shared[word] + 1) / size

    def given(word, before):
        own = {b: n for (a, b), n in pairs.items() if a == before}
        total = sum(own.values())
        back = 1 - sum(max(n - toxicity.PAIR_DISCOUNT, 0) for n in own.values()) / max(total, 1)
        return max(own.get(word, 0) - toxicity.PAIR_DISCOUNT, 0) / max(total, 1) + back * single(word)
    return lambda word, before: single(word) if before is None else given(word, before)


def test_same_ratios_as_a_plain_model(documents, labels, kept_table, monkeypatch):
    """Every word of every text, known to the model or not, after every word."""
    monkeypatch.setattr(toxicity, "HELD_WORDS", 50)
    rng = random.Random(2)
    words = ["".join(rng.choices("abcd", k=3)) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 41), k=rng.randint(0, 25)) + ["blorx snarg"] * (i % 3 == 0 and rng.random() < 0.9))) for i in range(200)]
    rows += [(500, "new words here aaa"), (501, None), (502, "")]
    known = labels([(i, 1, int(i % 3 == 0)) for i in range(200)])
    docs = documents(rows)
    model = toxicity.learn(docs, known, kept_table)
    chosen = {r.doc_id: r for r in toxicity.labelled(known).collect() if not r.calibrates}
    every = [toxicity.words_of(t) for _, t in rows]
    classes = [plain_model([t for (i, _), t in zip(rows, every, strict=True) if i in chosen and chosen[i].toxic == c], every) for c in (0, 1)]
    for text, found in zip([r[1] for r in rows], every, strict=True):
        want = [np.log(classes[1](w, b) / classes[0](w, b)) for w, b in zip(found, [None, *found][:len(found)], strict=True)]
        assert np.allclose(model.ratios(model.vocabulary.ids(text)), want, atol=1e-9), text


def test_phrase_that_follows_one_word_only(documents, labels, kept_table):
    """An insult in a fixed phrase has one left neighbour; it is caught by the pair's own counts."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(2000)]
    rows, known = [], []
    for i in range(3000):
        text = rng.choices(words, k=rng.randint(20, 150))
        if i % 4 == 0:
            text[rng.randrange(len(text)):0] = ["you filthy zorgon"]
        rows.append((i, " ".join(text)))
        known.append((i, 1, int(i % 4 == 0)))
    got = [r for r in toxicity.score(documents(rows), labels(known), kept_table).collect() if r.held_out]
    toxic, clean = ([r.predicted for r in got if (r.doc_id % 4 == 0) == t] for t in (True, False))
    assert np.mean(toxic) >= 0.95 and np.mean(clean) <= 0.05


def test_shared_counts_cover_every_word(documents):
    docs = documents([(1, "A b b"), (2, None), (3, "b c"), (3, "b c"), (None, "d")])
    assert {r.word: r.n for r in toxicity.shared_counts(docs).collect()} == {"a": 1, "b": 4, "c": 2, "d": 1}


def test_odd_rows(odd, no_documents, labels, kept_table):
    none = labels([])
    rows = toxicity.score(odd, none, kept_table).collect()
    assert len(rows) == 9 and {r.predicted for r in rows} == {0}
    assert toxicity.score(no_documents, none, kept_table).count() == 0
    assert toxicity.without_toxic(odd, labels([(5, None, 1), (None, 0, 1), (6, 1, None), (7, 1, 0)]), kept_table).count() == 9
