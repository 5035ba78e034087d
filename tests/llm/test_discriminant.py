import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import discriminant
from sampletide.llm.common import crc32_fold, table


def plain(text):
    """Statistics by their definitions, over words and characters one by one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return [0.0] * discriminant.SIZE
    n, chars = len(words), sum(map(len, words))

    def share(part, whole):
        return math.asin(math.sqrt(min(part / whole, 1))) if whole else 0.0

    def among(kind):
        return share(sum(b in kind for b in data), chars)
    lines = [x for x in data.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    found, counts, covered = Counter(zip(words, words[1:], words[2:])), Counter(words), set()
    for i in range(n - 2):
        if found[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    return [math.log1p(n), math.log(chars / n), math.log(n / len(lines)), math.log(len(counts)) / math.log(n) if n > 1 else 1.0,
            among(b"#*$%&|<>~^\\"), among(b"!?"), among(b".,;:"), among(b"0123456789"), among(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), among(b"\"'()+-/=@[]_`{}"),
            among(b"\n"), among(bytes(range(128, 256))), share(len(covered), n), share(max(counts.values()) - 1, n),
            share(sum(a == b for a, b in zip(words, words[1:])), n), share(len(lines) - len(set(lines)), len(lines)),
            share(sum(not (w[-1] >= 128 or w[-1:].isalpha()) for w in words), n)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abA# !.\n\té7-"), max_size=80))
def test_statistics(text):
    assert discriminant.statistics(text) == pytest.approx(plain(text), abs=1e-12)


def made(x):
    return np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])


def test_density_difference():
    """Against densities written out from the shrunken covariances, with determinants and inverses."""
    rng = np.random.default_rng(3)
    size = discriminant.SIZE
    low, high = rng.normal(0.3, 1, (400, size)) @ rng.normal(0, 1, (size, size)), rng.normal(0, 1, (900, size))
    model = discriminant.Discriminant(made(low), made(high), 0.3, 0.1)
    both = np.vstack([low, high])
    centre, scale = both.mean(0), both.std(0)
    a, b = (low - centre) / scale, (high - centre) / scale
    pooled = ((a - a.mean(0)).T @ (a - a.mean(0)) + (b - b.mean(0)).T @ (b - b.mean(0))) / (len(both) - 2)
    logs = []
    x = rng.normal(0, 1, (20, size))
    z = np.clip((x - centre) / scale, -discriminant.FARTHEST, discriminant.FARTHEST)
    for own in (a, b):
        covariance = 0.7 * np.cov(own.T) + 0.3 * pooled
        share = max(0.1, discriminant.shrinkage(covariance, len(own)))
        covariance = (1 - share) * covariance + share * np.eye(size)
        apart = z - own.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", apart, np.linalg.inv(covariance), apart) - 0.5 * np.linalg.slogdet(covariance)[1])
    want = logs[1] - logs[0] + np.log(900 / 400)
    assert model.evidence(x) == pytest.approx(np.sign(want) * np.log1p(np.abs(want)), rel=1e-6)


def test_sums_and_bins(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, discriminant.SIZE))
    rows = [(r.tolist(), int(i % 3 > 0), int(i % 4 == 0)) for i, r in enumerate(x)]
    sample = spark.createDataFrame(rows, "x array<double>, good int, choosing int").repartition(5)
    found = discriminant.sums(sample)
    for c in (0, 1):
        for g in (0, 1):
            own = x[[i for i, r in enumerate(rows) if r[1] == g and r[2] == c]]
            assert found[c, g] == pytest.approx(made(own))
    models = [discriminant.Discriminant(found[0, 0], found[0, 1], 0.0, r) for r in (0.05, 0.5)]
    counts = discriminant.binned(sample, models)
    assert counts.sum((1, 2)).tolist() == [300, 300] and counts[:, 1].sum(1).tolist() == [200, 200]


def test_curve():
    counts = np.zeros((2, discriminant.BINS))
    counts[0, 150], counts[1, 250], counts[0, 250], counts[1, 150] = 900, 900, 100, 100
    offset, slope, _ = discriminant.fitted_curve(counts)
    at = (np.array([150, 250]) + 0.5) * (20 / discriminant.BINS) - 10
    assert 1 / (1 + np.exp(-(offset + slope * at))) == pytest.approx([0.1, 0.9], abs=5e-3)


def test_held_out_accuracy(spark, kept_table):
    """Documents whose labels were not learned from: the better half of ten is not enough, nearly all must be right."""
    sf = "/root/testdata/sf0.01"
    scored = discriminant.score(table(spark, sf, "documents"), table(spark, sf, "labels"), kept_table)
    rows = scored.where("held_out").join(table(spark, sf, "labels"), "doc_id").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    low, high = [r.score for r in rows if r.quality == 0], [r.score for r in rows if r.quality == 1]
    assert np.mean([a < b for a in low for b in high]) > 0.98


def test_labels_of_the_held_out_fold_change_nothing(spark, documents, labels, kept_table):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["good", "words", "here", "and", "there"]) + ("###" if i % 4 == 0 else "") for _ in range(40))) for i in range(400)]
    docs = documents(rows)
    one = [(i, int(i % 4 > 0), 0) for i in range(400)]
    held = {r.doc_id for r in docs.where(crc32_fold(docs.doc_id, 5) == 0).collect()}
    other = [(i, 1 - q if i in held else q, t) for i, q, t in one]
    first, second = (sorted(tuple(r) for r in discriminant.score(docs, labels(x), kept_table).collect()) for x in (one, other))
    assert np.array(first, float) == pytest.approx(np.array(second, float)) and {r[0] for r in first if r[1]} == held
    assert all(r[3] == int(r[0] % 4 > 0) for r in first)


def test_odd_rows(odd, no_documents, labels, kept_table):
    none = labels([])
    rows = discriminant.score(odd, none, kept_table).collect()
    assert len(rows) == 9 and {r.score for r in rows} == {0.5} and not any(r.held_out for r in rows if r.doc_id is None)
    assert discriminant.score(no_documents, none, kept_table).collect() == []
    few = labels([(1, 1, None), (1, 1, 0), (2, None, None), (3, 1, 1), (5, 0, 0), (None, 1, 0)])
    assert all(0 < r.score < 1 for r in discriminant.score(odd, few, kept_table).collect())
