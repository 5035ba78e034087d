import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if found[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab# \n\té\x0b\x1c\xa0"), max_size=80))
def test_counts(text):
    assert quality.measured(text)[:5] == plain(text)


def test_exact_bound():
    # 1 - delta ** (1 / n) without any event; rule of three.
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01, abs=1e-9)
    assert quality.upper_bound(3, 50, 0.05) == pytest.approx(0.148, abs=2e-3)
    assert quality.upper_bound(5, 5, 0.05) == 1.0


def test_fixed_sequence_stops_at_the_first_failure():
    n = 10_000
    assert quality.strictest([0, 5, 20, 400, 0], n, 0.01, 0.01, (1.0, 0.9, 0.8, 0.7, 0.6)) == 0.8
    assert quality.strictest([0], 100, 0.01, 0.05, (1.0,)) is None
    assert quality.strictest([0], 0, 0.01, 0.05, (1.0,)) is None


def test_false_rejections_are_limited(documents, labels, kept_table):
    rng = random.Random(5)

    def text(symbols):
        return " ".join(rng.choice("ab") * rng.randint(2, 9) + str(rng.randint(0, 999)) + ("#" if rng.random() < symbols else "") for _ in range(80))
    rows = [(i, text(0.02 if i % 4 else 0.95), "en" if i % 3 else "de") for i in range(24_000)]
    lab = labels([(i, int(i % 4 > 0), 0) for i in range(20_000)])
    got = {r.doc_id: r for r in quality.judge(documents(rows), lab, kept_table).collect()}
    for lang in ("en", "de"):
        good = [i for i, _, l in rows if l == lang and i % 4]
        assert sum(not got[i].kept for i in good) <= quality.RISK * len(good)
    bad = [i for i, _, _ in rows if i % 4 == 0]
    assert sum(not got[i].kept for i in bad) > 0.9 * len(bad)
    assert all("symbols" in got[i].failed_rules for i in bad if not got[i].kept)


def test_odd_rows(odd, no_documents, labels, kept_table):
    none = labels([])
    rows = quality.judge(odd, none, kept_table).collect()
    assert len(rows) == 9 and [r.kept for r in rows if r.n_words == 60_000] == [False]
    assert sum(r.base_failed for r in rows) == 9
    assert quality.judge(no_documents, none, kept_table).count() == 0
    repeated = labels([(1, 1, None), (1, 1, 0), (None, 1, 0), (2, None, None)])
    assert quality.judge(odd, repeated, kept_table).count() == 9


def test_few_labels_are_enough(documents, labels, kept_table):
    """440 good labels in each of four languages certify cutoffs of several rules; 430 are pooled with the smallest of them."""
    rng = random.Random(6)

    def text(kind):
        found = ["".join(rng.choices("abcdefgh", k=5)) + "#" * (kind == "symbols") for _ in range(100)]
        return " ".join(w.upper() if kind == "upper" else w for w in found)
    rows, known = [], []
    for lang, good in (("en", 440), ("de", 440), ("fr", 440), ("es", 430)):
        for kind in ["good"] * good + ["symbols", "upper"] * 20:
            rows.append((len(rows), text(kind), lang))
            known.append((len(known), int(kind == "good"), 0))
    assert min(n for n in range(1, 1000) if quality.upper_bound(0, n, quality.DELTA / 4) <= quality.RISK) == 437
    got = {r.doc_id: r for r in quality.judge(documents(rows), labels(known), kept_table).collect()}
    for (i, _, lang), (_, good, _) in zip(rows, known, strict=True):
        assert got[i].kept == bool(good), (lang, got[i])
    rules = {r for g in got.values() for r in g.failed_rules.split(",") if r}
    assert {"symbols", "upper"} <= rules


def plain_cutoffs(rows, good):
    """Cutoffs by trying every move of the path on every good document: {stratum: {rule: cutoff}}."""
    held = {}
    for i, text, lang in rows:
        m = quality.measured(text)
        if i in good and m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            held.setdefault(lang, []).append(m[5:])
    alone = dict(held)
    while True:
        pool = [m for lang, own in held.items() if lang not in alone for m in own]
        level = quality.DELTA / max(len(alone) + bool(pool), 1)
        short = [x for x, own in alone.items() if quality.upper_bound(0, len(own), level) > quality.RISK]
        if not short and alone and pool and quality.upper_bound(0, len(pool), level) > quality.RISK:
            short = [min(alone, key=lambda x: (len(alone[x]), x))]
        if not short:
            break
        for x in short:
            del alone[x]
    out = {}
    for lang in held:
        own, cut = alone.get(lang, pool), {}
        for rule, step in quality.PATH:
            trial = cut | {rule: quality.STEPS[step]}
            k = sum(any(m[r] >= c - 1e-12 for r, c in trial.items()) for m in own)
            if quality.upper_bound(k, len(own), level) > quality.RISK:
                break
            cut = trial
        out[lang] = {quality.RULES[r]: c for r, c in cut.items()}
    return out


def test_cutoffs_and_verdicts_of_pooled_strata(documents, labels, kept_table):
    """Strata too small to stand alone share the cutoffs of their pool; a language without labels has none."""
    rng = random.Random(8)
    rows = []
    for lang, n in (("en", 900), ("de", 260), ("fr", 270), ("es", 60), ("it", 30)):
        for i in range(n):
            words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) + "#" * (rng.random() < (0.9 if i % 7 == 0 else 0.01)) for _ in range(90)]
            rows.append((len(rows), " ".join(w.upper() if i % 11 == 0 else w for w in words), lang))
    good = {i for i, t, lang in rows if t.count("#") < 20 and not t.isupper() and lang != "it"}
    known = [(i, int(i in good), 0) for i, _, lang in rows if lang != "it"]
    measured = kept_table(quality.signals(documents(rows)), "test-signals")
    cuts = {r.stratum: {n: r[f"cut_{n}"] for n in quality.RULES if r[f"cut_{n}"] is not None} for r in quality.cutoffs(measured, labels(known)).collect()}
    want = plain_cutoffs(rows, good)
    assert cuts == want and cuts["de"] == cuts["fr"] == cuts["es"] and "symbols" in cuts["de"] and "it" not in cuts
    got = {r.doc_id: r for r in quality.judge(documents(rows), labels(known), kept_table).collect()}
    for i, text, lang in rows:
        m = quality.measured(text)
        fails = [r for r, v in zip(quality.RULES, m[5:], strict=True) if v >= want.get(lang, {}).get(r, 9) - 1e-12]
        assert got[i].failed_rules == ",".join(fails) and got[i].kept == (not got[i].base_failed and not fails)


def test_strata_that_stand_alone():
    need = quality.needed(quality.DELTA, quality.RISK)
    assert need == 299 and quality.upper_bound(0, need, quality.DELTA) <= quality.RISK < quality.upper_bound(0, need - 1, quality.DELTA)
    one = lambda large, others: quality.standing(large, others, quality.RISK, quality.DELTA)
    assert one({"a": 299}, 0) == ({"a"}, quality.DELTA)
    assert one({"a": 400, "b": 350}, 10) == (set(), quality.DELTA)
    assert one({"a": 900, "b": 450}, 500) == ({"a", "b"}, quality.DELTA / 3)
    assert one({"a": 900, "b": 450}, 10) == ({"a"}, quality.DELTA / 2)
    assert one({}, 0) == (set(), quality.DELTA)
