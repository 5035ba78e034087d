"""Near-duplicate documents: MinHash signatures met in an inverted index of coordinate values.

1. A task turns a text into the set of its word shingles, a digest of the set and a signature of COORDINATES minima.
   Texts with the same set are one class, of which one signature goes on.
2. A class is posted under each of its coordinate values. Two classes whose sets are similar enough to link agree in
   at least MATCHES coordinates (but for a chance below one in a million), so values of a single class are dropped, and
   of the others, rarest first, a class needs only those up to the MATCHES-th from the end: two classes with MATCHES
   common values meet in such a prefix. Lists with the same members are merged once.
3. In a list, coinciding coordinates of its members are counted; pairs of MATCHES and more are joined at once into
   sets, so a list gives one row per member. Long lists are cut into blocks, and pairs of blocks are counted apart.
4. Components of those rows hold every true link. In each, full shingle sets are compared, block by block, and pairs
   that reach the similarity are joined in the same way; their components are the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import mapped, travels
from sampletide.llm.components import Sets, connected, groups_of

travels(__name__)

WORDS, PERCENT = 5, 80
COORDINATES, MATCHES = 64, 34
BLOCK, BLOCK_BYTES = 512, 16_000_000
# Bits of the filter that keeps texts without a candidate out of the comparison: 2 MB at the driver, whatever the input.
FILTER_BITS = 1 << 24
REMEMBERED = 500_000

_DRAW = np.random.default_rng(20240229)
_XOR = _DRAW.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_TIMES = _DRAW.integers(0, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _DRAW.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(found: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; those met before in this worker are remembered, within bounds."""
    import sys
    import types

    import xxhash
    known = sys.modules.setdefault("_words_of_this_worker", types.ModuleType("_words_of_this_worker")).__dict__
    try:
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(found) if w not in known)
    return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `size` words, A-Z lower-cased; a shorter text is one shingle."""
    found = [] if not text else text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes, size = word_hashes(found), min(size, len(found))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        total += hashes[i:len(hashes) - size + 1 + i] * _PLACE[i]
    return np.unique(mixed(total))


def signature(own: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 4096):
        np.minimum(least, ((own[i:i + 4096, None] ^ _XOR) * _TIMES).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def digest(own: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(own.tobytes())


def sketches(docs: DataFrame, size: int = WORDS, number: str | None = None) -> DataFrame:
    """doc_id, n_shingles, digest, signature of every row, and its row (column `number`); no digest without words."""
    def task(columns):
        import pyarrow as pa
        counts, digests, parts = [], [], []
        for text in columns["text"].to_pylist():
            own = shingles(text, size)
            counts.append(len(own))
            digests.append(digest(own) if len(own) else None)
            parts.append(signature(own) if len(own) else np.zeros(COORDINATES, np.int32))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(parts) + 1) * COORDINATES, pa.int32()), pa.array(np.concatenate(parts)))
        made = {"doc_id": columns["doc_id"], "n_shingles": counts, "digest": digests, "signature": pa.array(lists.to_pylist(), pa.list_(pa.int32()))}
        return made | ({"row": columns["row"]} if number else {})
    more = [F.col(number).alias("row")] if number else []
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more), task,
                  "doc_id long, n_shingles long, digest binary, signature array<int>" + (", row long" if number else ""))


def blocks(members: DataFrame, sizes: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """Members of each group once per pair of blocks they are compared in: key, i, j, block, node, payload.

    `sizes` has key and `cut`, the number of blocks; a node's block is a hash of it, so blocks are even."""
    cut = members.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("cut")).cast("int"))
    return (cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut").cast("int") - 1)))
            .select(key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", *payload)
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "block", "node"))


def starred(groups: DataFrame, linked) -> DataFrame:
    """a, b: every linked member of a group and the root of its set. `linked(batch, x, y)` says which rows of two
    ranges of a group link, as a boolean matrix."""
    def run(batches):
        import pyarrow as pa
        left, right, = [], []
        for group in groups_of(batches, 3):
            n = group.num_rows
            if n > 1:
                block = group.column(3).to_numpy(zero_copy_only=False)
                node = group.column(4).to_numpy(zero_copy_only=False)
                cut = int(np.searchsorted(block, block[0], "right"))
                same = cut == n
                if not same or group.column(1)[0].as_py() == group.column(2)[0].as_py():
                    first, second = np.arange(cut), np.arange(n) if same else np.arange(cut, n)
                    sets = Sets(n)
                    sets.join_all(linked(group, first, second), first, second)
                    roots = sets.roots()
                    moved = np.flatnonzero(roots != np.arange(n))
                    left.append(node[moved])
                    right.append(node[roots[moved]])
            if sum(map(len, left)) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])
                left, right = [], []
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])
    return groups.mapInArrow(run, "a long, b long")


def by_coordinates(group, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    rows = group.column(5).flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, COORDINATES)
    one, two = rows[x[0]:x[-1] + 1], rows[y[0]:y[-1] + 1]
    count = np.zeros((len(one), len(two)), np.uint8)
    for k in range(COORDINATES):
        count += one[:, k, None] == two[None, :, k]
    return count >= MATCHES


def candidates(reps: DataFrame, written) -> DataFrame:
    """a, b: links whose components hold every pair of classes that agree in MATCHES coordinates."""
    posted = reps.select("node", F.posexplode("signature").alias("k", "value")).select(
        "node", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key"))
    shared = written(posted.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "minhash-shared")
    own = (posted.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("own"))
           .where(F.size("own") >= MATCHES))
    prefix = written(own.select("node", F.explode(F.expr(f"slice(own, 1, size(own) - {MATCHES - 1})")).alias("p"))
                     .select("node", F.col("p.key").alias("key")), "minhash-prefix")
    # Lists with the same members are one: as many, with the same exclusive-or of two hashes.
    lists = (prefix.groupBy("key").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(node))").alias("x"), F.expr("bit_xor(xxhash64(node, 1))").alias("y"))
             .where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")))
    lists = written(lists.select("key", F.ceil(F.col("n") / BLOCK).alias("cut")), "minhash-lists")
    members = prefix.join(lists.select("key"), "key", "left_semi").join(reps.select("node", "signature"), "node")
    return written(starred(blocks(members, lists, "key", ["signature"]), by_coordinates), "minhash-candidates")


def compared(percent: int):
    def linked(group, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        own = [np.frombuffer(b, np.uint64) for b in group.column(5).to_pylist()]
        sizes = np.array([len(s) for s in own], np.int64)
        if len(x) * len(y) <= 64:
            common = np.array([[len(np.intersect1d(own[i], own[j], assume_unique=True)) for j in y] for i in x], np.int64)
        else:
            common = intersections([own[i] for i in x], [own[j] for j in y])
        return 100 * common >= percent * (sizes[x][:, None] + sizes[y][None, :] - common)
    return linked


def intersections(one: list[np.ndarray], two: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 matrices over the shingles that both sides hold, some at a time."""
    a, b = np.concatenate(one), np.concatenate(two)
    both = np.intersect1d(a, b)
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (one, two)]
    places = [np.searchsorted(both, v) for v in (a, b)]
    hits = [(p < len(both)) & (both[np.minimum(p, len(both) - 1)] == v) if len(both) else np.zeros(len(v), bool) for p, v in zip(places, (a, b), strict=True)]
    out = np.zeros((len(one), len(two)))
    for start in range(0, len(both), width):
        sides = []
        for n, row, place, hit in zip((len(one), len(two)), rows, places, hits, strict=True):
            here = hit & (place >= start) & (place < start + width)
            side = np.zeros((n, min(width, len(both) - start)), np.float32)
            side[row[here], place[here] - start] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out.astype(np.int64)


def full_sets(docs: DataFrame, chosen: DataFrame, size: int) -> DataFrame:
    """digest, shingles (bytes) of the texts in classes `chosen` (digest, rep). Other texts are passed over by their
    id in a filter of FILTER_BITS bits, and what a full filter lets through by the join."""
    def bit(column):
        return F.pmod(F.xxhash64(F.coalesce(column, F.lit(-1))), F.lit(FILTER_BITS))
    rows = (chosen.select(bit(F.col("rep")).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    bits = {r.bucket: bytes(r.bits) for r in rows}

    def task(columns):
        out = {"digest": [], "shingles": []}
        for text, bucket, place in zip(columns["text"], columns["bucket"].to_pylist(), columns["place"].to_pylist(), strict=True):
            own = bits.get(bucket)
            if own and own[place >> 3] >> (place & 7) & 1:
                made = shingles(text.as_py(), size)
                if len(made):
                    out["digest"].append(digest(made))
                    out["shingles"].append(made.tobytes())
        return out
    place = bit(F.col("doc_id").cast("long"))
    made = mapped(docs.select("text", F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("place")), task,
                  "digest binary, shingles binary")
    return made.join(chosen, "digest").dropDuplicates(["digest"])


def linked_classes(docs: DataFrame, reps: DataFrame, written, size: int, percent: int) -> DataFrame:
    """node, root of the classes that link to another; `reps` has node, digest, rep and signature of all classes."""
    maybe = written(connected(candidates(reps, written), written), "minhash-maybe")
    member = maybe.select("node", F.col("root").alias("part")).union(maybe.select("root", "root").distinct())
    chosen = written(member.join(reps.select("node", "digest", "rep"), "node"), "minhash-chosen")
    sets = written(full_sets(docs, chosen.select("digest", "rep", "node", "part"), size).select("part", "node", "shingles"), "minhash-sets")
    sizes = sets.groupBy("part").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.length("shingles")) / BLOCK_BYTES)).alias("cut"))
    sizes = written(sizes, "minhash-parts")
    links = written(starred(blocks(sets, sizes, "part", ["shingles"]), compared(percent)), "minhash-links")
    return written(connected(links, written), "minhash-components")


def near_duplicates(docs: DataFrame, written, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of `docs`.

    component_id is the smallest id that links reach, the document's own included; kept marks it. Null, empty and
    blank texts have no shingles and link with nothing. Rows alike in text are one class, whatever their number; rows
    that repeat an id stay apart. Null ids have no part in the smallest id; where a component has no other, its rows
    have a null component_id and are kept. Other columns are not read.
    """
    own = written(sketches(docs, size), "minhash-sketches")
    classes = own.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("signature").alias("signature"))
    reps = written(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    found = linked_classes(docs, reps, written, size, percent)
    label = found.union(found.select("root", "root").distinct()).join(reps.select("node", "rep"), "node")
    least = label.groupBy("root").agg(F.min("rep").alias("least"))
    linked = label.join(least, "root").select("node", "least")
    final = written(reps.select("digest", "rep", "n", "node").join(linked, "node", "left").where("n > 1 or least is not null")
                    .select("digest", F.coalesce("least", "rep").alias("component_id")), "minhash-final")
    out = own.select("doc_id", "n_shingles", "digest").join(final, "digest", "left")
    return (out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")))


def without_near_duplicates(docs: DataFrame, written, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of `docs` per component; all columns stay.

    It is the row with the smallest id, of several the first one as written; rows without an id come last. Rows are
    told apart by a number of their own, so ids may be null or repeat. Rows without words stay.
    """
    number = "_row"
    while number in map(str.lower, docs.columns):
        number += "_"
    docs = written(docs.withColumn(number, F.monotonically_increasing_id()), "minhash-rows")
    own = written(sketches(docs, size, number), "minhash-sketches")
    # False comes before true: an id before none.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = own.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("signature").alias("signature"), first)
    reps = written(classes.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")
    found = linked_classes(docs, reps, written, size, percent)
    label = found.union(found.select("root", "root").distinct()).join(reps.select("node", "first"), "node")
    linked = label.join(label.groupBy("root").agg(F.min("first").alias("least")), "root").select("node", "least")
    stands = written(reps.select("digest", "n", "node", "first").join(linked, "node", "left").where("n > 1 or least is not null")
                     .select("digest", F.coalesce("least", "first")["row"].alias("stands")), "minhash-final")
    gone = own.select("digest", "row").join(stands, "digest").where("row <> stands").select(F.col("row").alias(number))
    return docs.join(written(gone, "minhash-gone"), number, "left_anti").drop(number)
