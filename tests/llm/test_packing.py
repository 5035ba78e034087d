import random
from collections import Counter, defaultdict

from sampletide.llm import packing


def plain(pieces, capacity, per_source):
    """Best fit by trying every bin."""
    bins, out = [], []
    for size, source, cluster in pieces:
        best = None
        for number, held in enumerate(bins):
            room = capacity - sum(h[0] for h in held)
            clash = cluster is not None and any(h[2] == cluster for h in held) or source is not None and sum(h[1] == source for h in held) >= per_source
            if room >= size and room > 0 and not clash and (best is None or room < best[0]):
                best = room, number
        if best is None:
            bins.append([])
            best = capacity, len(bins) - 1
        out.append((best[1], sum(h[0] for h in bins[best[1]])))
        bins[best[1]].append((size, source, cluster))
    return out


def test_same_as_trying_every_bin():
    rng = random.Random(3)
    for n in (0, 1, 5, 300):
        rows = sorted(((rng.randint(1, 100), rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, *"pqrs", *range(n)])) for _ in range(n)), key=lambda r: -r[0])
        got = packing.packed(*([r[i] for r in rows] for i in range(3)), 100, 2) if rows else []
        assert got == plain(rows, 100, 2)


def test_table(documents, kept_table):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 7, 20, 49, 50, 120]))) + f" x{i % 40}" * (i % 3), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)]
    got = packing.pack(documents(rows), kept_table, capacity=50, group=100).collect()
    words, source, text = {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[3] for r in rows}, {r[0]: " ".join(r[1].split()) for r in rows}
    held, bins = defaultdict(list), defaultdict(list)
    for r in got:
        held[r.doc_id].append((r.first_word, r.n_words))
        assert (r.bin_id is None) == (words[r.doc_id] == 0)
        if r.bin_id:
            bins[r.bin_id].append(r)
    for doc, n in words.items():  # every word once
        at = 0
        for first, size in sorted(held[doc]):
            assert first == at
            at += size
        assert at == n
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.place):
            assert r.place == at
            at += r.n_words
        assert at <= 50
        assert len({text[r.doc_id] for r in own}) == len(own)
        assert max(Counter(source[r.doc_id] for r in own).values()) <= packing.PER_SOURCE


def test_odd_rows(odd, no_documents, kept_table):
    rows = packing.pack(odd, kept_table).collect()
    assert len(rows) == 8 + 30  # the long text is 29 full pieces and a rest
    assert sum(r.bin_id is None for r in rows) == 4
    assert packing.pack(no_documents, kept_table).count() == 0


def test_equal_tables_give_equal_bins(documents, kept_table):
    """Whatever the partitions and the order of rows, repeated rows, nulls and long texts included."""
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(300)]), " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.choice([0, 3, 20, 49, 50, 130]))), "en", rng.choice(["a", "b", None])) for _ in range(400)]
    rows += rows[:60] * 2
    found = []
    for parts in (1, 4, 7):
        rng.shuffle(rows)
        got = packing.pack(documents(rows).repartition(parts), kept_table, capacity=50, group=100).collect()
        found.append(sorted(map(tuple, got), key=str))
    assert found[0] == found[1] == found[2] and len({r[4] for r in found[0]}) > 50
