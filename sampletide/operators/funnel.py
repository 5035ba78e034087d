"""Counts over lineage where many records were made of few: a small core is walked in memory, all others go by once.

Edges lead from a child to its parent. Ids that are nobody's parent (the lower ones) are reached by no id, and ids that only
those reach pass on what they have themselves. Neither need a set that is kept: what is left, the core, is numbered and sent to
every task. Lower ids are dealt to blocks of near ones; a block gets its edges and, once each, the core parents of the
ids that its edges lead to. A task walks one block at a time, so pairs of id and reached id exist only in its memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampletide.operators.running import running
from sampletide.session import materialise

# Ids and edges of a core that every task holds: names of some 40 bytes, four bytes an edge.
CORE = 200_000
CORE_EDGES = 4_000_000
# Hashes of ids sent to every task, eight bytes each.
KNOWN = 2_000_000
# Edges of a block, fewer where a set has more core parents than KIN; ranges that ids are told apart by; sampled ids of a block; blocks that
# one id may fill.
BLOCK = 250_000
KIN = 64
RANGES = 512
SAMPLED = 100
HOT = 4
# Pairs of id and core id that a walk has a byte for; rows of counts held before they are added up.
PAIRS = 16_000_000
COUNTS = 2_000_000
RESULT = "lid string, steps int, n long, first string, last string"


def _by_child(links: DataFrame, ids: DataFrame, many: bool, how: str) -> DataFrame:
    """Links whose lower end is among `ids` (left_semi) or not (left_anti), by hashes: an id that shares its hash with one of them is
    taken for one of them on both sides, which makes it no parent."""
    keys = ids.select(F.xxhash64("lid").alias("_key")).distinct()
    return links.join(keys if many else F.broadcast(keys), F.xxhash64("at") == F.col("_key"), how)


def _under(key: str, bounds: list[str], first: int = 0) -> Column:
    """Number of bounds that are not above the key."""
    if not bounds:
        return F.lit(first)
    half = len(bounds) // 2
    return F.when(F.col(key) < F.lit(bounds[half]), _under(key, bounds[:half], first)).otherwise(_under(key, bounds[half + 1:], first + half + 1))


def _blocks(ids: DataFrame, near: list[str], n: int, block: int):
    """A function that numbers the block of a column, or None if an id fills several blocks, and how many blocks there are."""
    parts = max(1, -(-n // block))
    ranges = min(parts, RANGES)
    split = -(-parts // ranges)
    key = F.concat_ws("\t", *[F.expr(e) for e in near], F.col("lid"))
    bounds: list[str] = []
    if parts > 1:
        drawn = ids.sample(min(1.0, SAMPLED * parts / n), seed=7).groupBy(key.alias("key")).count().orderBy("key").collect()
        total = sum(r["count"] for r in drawn)
        if max((r["count"] for r in drawn), default=0) > HOT * max(SAMPLED, total / parts):
            return None, parts
        upto = 0
        for r in drawn:
            if upto * ranges >= (len(bounds) + 1) * total:
                bounds.append(r["key"])
            upto += r["count"]

    def numbered(rows: DataFrame, name: str) -> DataFrame:
        if parts == 1:
            return rows.withColumn("block", F.lit(0))
        keyed = rows.withColumn("lid", F.col(name)).withColumn("_key", key)
        place = _under("_key", bounds) * split + F.pmod(F.xxhash64(F.col(name)), F.lit(split))
        return keyed.withColumn("block", place.cast("int")).drop("_key", *([] if name == "lid" else ["lid"]))

    return numbered, parts


def totals(edges: DataFrame, ids: DataFrame, upward: bool = True, near: list[str] | None = None, only_roots: bool = False,
           core: int = CORE, block: int = BLOCK) -> DataFrame | None:
    """As `closure.totals`, or None where it does not apply: the core is large, or an id has edges for several blocks."""
    if only_roots and not upward:
        return None
    spark = edges.sparkSession
    links = edges.select(F.col("child_lid").alias("at"), F.col("parent_lid").alias("to")).where("at is not null and to is not null")
    # Edges are read several times: once from where they come from.
    links = materialise(links, "edges", compression="zstd")
    starts = ids.select("lid").where("lid is not null")
    reached = materialise(links.select(F.col("to").alias("lid")).distinct(), "reached")
    n_reached = reached.count()
    many = n_reached > KNOWN
    inner = _by_child(links, reached, many, "left_semi")
    found = materialise(inner.select(F.col("to").alias("lid")).distinct(), "core")
    if not n_reached or found.count() > core:
        return None
    names = materialise(running(found, ["lid"], {"place": F.lit(1)}).select("lid", (F.col("place") - 1).cast("int").alias("place")), "core-places")
    # What ids that have edges and are reached themselves have for parents: only ids of the core.
    sets = inner.join(F.broadcast(names.select(F.col("lid").alias("to"), "place")), "to")
    sets = materialise(sets.groupBy(F.col("at").alias("lid")).agg(F.sort_array(F.collect_set("place")).alias("kin"), F.count(F.lit(1)).alias("n")), "sets")
    own = sets.join(F.broadcast(names), "lid")
    n_sets, n_inner = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if (own.agg(F.sum(F.size("kin"))).first()[0] or 0) > CORE_EDGES:
        return None
    lower = _by_child(links, reached, many, "left_anti")
    n = links.count() - n_inner + n_sets
    block = max(1, block * KIN // max(KIN, n_inner // max(1, n_sets)))
    numbered, parts = _blocks(lower.select(F.col("at").alias("lid")).unionByName(sets.select("lid")), near or [], n, block)
    if numbered is None:
        return None
    none, no_kin = F.lit(None).cast("string").alias("to"), F.lit(None).cast("array<int>").alias("kin")
    dealt = numbered(lower, "at")
    met = materialise(dealt.select("block", F.col("to").alias("lid")).distinct(), "met")
    rows = [dealt.select("block", F.lit(0).alias("kind"), "at", "to", no_kin),
            met.join(sets, "lid").select("block", F.lit(1).alias("kind"), F.col("lid").alias("at"), none, "kin"),
            numbered(sets, "lid").select("block", F.lit(2).alias("kind"), F.col("lid").alias("at"), none, "kin")]
    if upward:
        rows.append(numbered(starts, "lid").select("block", F.lit(3).alias("kind"), F.col("lid").alias("at"), none, no_kin))
    else:
        rows.append(met.join(starts, "lid", "left_semi").select("block", F.lit(3).alias("kind"), F.col("lid").alias("at"), none, no_kin))
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    told = names if upward else names.join(starts.withColumn("told", F.lit(True)).distinct(), "lid", "left")
    told = told.withColumn("told", F.lit(True)) if upward else told.withColumn("told", F.coalesce("told", F.lit(False)))
    told = told.orderBy("place").select("lid", "told").toArrow()
    kept = spark.sparkContext.broadcast(_core(told, own.select("place", "kin").toArrow(), upward, only_roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _one_by_one(batches):
            yield from _counted(one, **kept.value)

    counted = every.repartitionById(parts, F.col("block")).sortWithinPartitions("block").mapInArrow(run, RESULT)
    if upward:
        return counted
    return counted.groupBy("lid", "steps").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def _core(told: pa.Table, own: pa.Table, upward: bool, only_roots: bool) -> dict:
    """Names in order, and per number of a core id where its parents begin in `ends`."""
    names = told["lid"].combine_chunks().cast(pa.string())
    place, kin = own["place"].to_numpy(), own["kin"].combine_chunks()
    order = np.argsort(place, kind="stable")
    kin = kin.take(pa.array(order))
    begins = np.zeros(len(names) + 1, np.int64)
    begins[place + 1] = own["kin"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return dict(names=names, told=told["told"].to_numpy(), begins=np.cumsum(begins), ends=kin.flatten().to_numpy(), upward=upward, only_roots=only_roots)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block; they come one block after the other."""
    held, current = [], None
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            if held and blocks[lo] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = blocks[lo]
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _strings(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays([c.cast(pa.string()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.string())


def _sorted(values: pa.Array) -> pa.Array:
    values = values.unique()
    return values.take(pc.sort_indices(values))


def _at(values: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each value is among others, or -1."""
    return pc.fill_null(pc.index_in(values, value_set=among), -1).to_numpy().astype(np.int64)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin and end."""
    cuts = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    return np.concatenate([[0], cuts])[:len(ordered)], np.concatenate([cuts, [len(ordered)]])[:len(ordered)]


def _listed(which: np.ndarray, begins: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists one after the other, and how many each list has."""
    lengths = begins[which + 1] - begins[which]
    total = int(lengths.sum())
    at = np.arange(total) + np.repeat(begins[which] - (np.cumsum(lengths) - lengths), lengths)
    return values[at], lengths


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])[:len(values)]]


def _walk(x: np.ndarray, one: tuple, two: tuple, begins: np.ndarray, ends: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(steps, ids, core ids) of what the ids `x`, consecutive numbers, reach: the pairs of each number of steps in order. `one` and `two` have
    the pairs that lie at one step, and those met at two. A pair is a number whose lower `bits` are its core id."""
    base, mask, seen = int(x[0]), (1 << bits) - 1, np.zeros(len(x) << bits, bool)
    single = len(ends) == len(begins) - 1 and bool((begins[1:] - begins[:-1] == 1).all())
    front, steps = _distinct((one[0] - base << bits) + one[1]), 1
    waiting = (two[0] - base << bits) + two[1]
    while len(front) or len(waiting):
        nodes = front & mask
        if len(front):
            seen[front] = True
            yield steps, (front >> bits) + base, nodes
        if single:
            following = front - nodes + ends[nodes]
        else:
            on, lengths = _listed(nodes, begins, ends)
            following = np.repeat(front - nodes, lengths) + on
        if steps == 1:
            following, waiting = np.concatenate([following, waiting]), waiting[:0]
        following = following[~seen[following]]
        front, steps = _distinct(following), steps + 1


def _added(parts: list[tuple]) -> list[tuple]:
    """Counts, first and last added up by code."""
    codes, n, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, n, first, last = codes[order], n[order], first[order], last[order]
    begin, _ = _runs(codes)
    return [(codes[begin], np.add.reduceat(n, begin), np.minimum.reduceat(first, begin), np.maximum.reduceat(last, begin))]


def _per_core(ids: np.ndarray, nodes: np.ndarray, steps: int, wide: int) -> tuple:
    """Per core id: how many ids reach it, the first and the last; ids come in order."""
    if len(nodes) * 8 < wide:
        order = np.argsort(nodes, kind="stable")
        held = nodes[order]
        begin, end = _runs(held)
        return held[begin] + steps * wide, end - begin, ids[order[begin]], ids[order[end - 1]]
    n, first, last = np.bincount(nodes, minlength=wide), np.zeros(wide, np.int64), np.zeros(wide, np.int64)
    # Of equal places the last one assigned stays.
    first[nodes[::-1]] = ids[::-1]
    last[nodes] = ids
    some = np.flatnonzero(n)
    return some + steps * wide, n[some], first[some], last[some]


def _rows(lid: pa.Array, steps, n: np.ndarray, first: pa.Array, last: pa.Array) -> pa.RecordBatch:
    steps = np.full(len(n), steps, np.int32) if np.isscalar(steps) else steps.astype(np.int32)
    return pa.RecordBatch.from_arrays([lid, pa.array(steps), pa.array(n.astype(np.int64)), first, last], names=["lid", "steps", "n", "first", "last"])


def _counted(block: pa.Table, names: pa.Array, told: np.ndarray, begins: np.ndarray, ends: np.ndarray, upward: bool, only_roots: bool) -> Iterator[pa.RecordBatch]:
    kind, bits = block["kind"].to_numpy(), max(1, (len(names) - 1).bit_length())
    wide = 1 << bits
    low, kin, own, starts = (block.filter(pa.array(kind == k)) for k in range(4))
    lower, upper, inner, asked = _strings(low["at"]), _strings(low["to"]), _strings(own["at"]), _strings(starts["at"])
    xs = _sorted(pa.concat_arrays([lower, inner]))
    if upward:
        xs = xs.filter(pc.is_in(xs, value_set=asked))
    if not len(xs):
        return
    x, ys = _at(lower, xs), _sorted(upper)
    pairs = _distinct((x * len(ys) + _at(upper, ys))[x >= 0])
    x, y = (pairs // len(ys), pairs % len(ys)) if len(ys) else (pairs, pairs)
    in_core, of_kin = _at(ys, names), _at(ys, _strings(kin["at"]))
    wanted = (begins[1:] == begins[:-1]) if only_roots else told
    # One step up from lower ids is every id their edges lead to, of the core or not.
    counted = np.ones(len(ys), bool)
    if only_roots:
        counted = np.where(in_core >= 0, begins[in_core + 1] == begins[in_core], of_kin < 0) if len(names) else of_kin < 0
    if upward:
        at, to = x[counted[y]], y[counted[y]]
        begin, end = _runs(at)
        yield _rows(xs.take(pa.array(at[begin])), 1, end - begin, ys.take(pa.array(to[begin])), ys.take(pa.array(to[end - 1])))
    else:
        aside = (in_core < 0) & (_at(ys, asked) >= 0)
        order = np.argsort(y[aside[y]], kind="stable")
        at, to = x[aside[y]][order], y[aside[y]][order]
        begin, end = _runs(to)
        yield _rows(ys.take(pa.array(to[begin])), 1, end - begin, xs.take(pa.array(at[begin])), xs.take(pa.array(at[end - 1])))
    lists = kin["kin"].combine_chunks() if kin.num_rows else pa.array([], pa.list_(pa.int32()))
    kin_begins, kin_ends = _offsets(lists)
    lists = own["kin"].combine_chunks() if own.num_rows else pa.array([], pa.list_(pa.int32()))
    own_x, (own_begins, own_ends) = _at(inner, xs), _offsets(lists)
    order = np.argsort(own_x, kind="stable")
    order = order[own_x[order] >= 0]
    own_x, most, sums = own_x[order], max(1, PAIRS // wide), []
    limit = COUNTS
    for begin in range(0, len(xs), most):
        part = np.arange(begin, min(begin + most, len(xs)))
        a, b = np.searchsorted(x, [part[0], part[-1] + 1])
        c, d = np.searchsorted(own_x, [part[0], part[-1] + 1])
        px, py = x[a:b], y[a:b]
        direct, by_kin = in_core[py] >= 0, (in_core[py] < 0) & (of_kin[py] >= 0)
        onward, lengths = _listed(of_kin[py[by_kin]], kin_begins, kin_ends)
        two = np.repeat(px[by_kin], lengths), onward
        onward, lengths = _listed(order[c:d], own_begins, own_ends)
        one = np.concatenate([px[direct], np.repeat(own_x[c:d], lengths)]), np.concatenate([in_core[py[direct]], onward])
        made = []
        for steps, ids, nodes in _walk(part, one, two, begins, ends, bits):
            if upward and steps == 1 and c < d:
                # Steps of one from lower ids are counted above, with ids outside the core.
                inside = np.isin(ids, own_x[c:d])
                ids, nodes = ids[inside], nodes[inside]
            elif upward and steps == 1:
                continue
            kept = wanted[nodes]
            if not kept.all():
                ids, nodes = ids[kept], nodes[kept]
            if not len(ids):
                continue
            if not upward:
                sums.append(_per_core(ids, nodes, steps, wide))
                continue
            i, j = _runs(ids)
            made.append((ids[i], np.full(len(i), steps), j - i, nodes[i], nodes[j - 1]))
        if made:
            ids, steps, n, first, last = (np.concatenate(c) for c in zip(*made, strict=True))
            yield _rows(xs.take(pa.array(ids)), steps, n, names.take(pa.array(first)), names.take(pa.array(last)))
        if sum(len(s[0]) for s in sums) > limit:
            sums = _added(sums)
            limit = max(COUNTS, 2 * len(sums[0][0]))
    if sums:
        codes, n, first, last = _added(sums)[0]
        yield _rows(names.take(pa.array(codes % wide)), codes // wide, n, xs.take(pa.array(first)), xs.take(pa.array(last)))


def _offsets(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where lists begin and end among their values, and the values."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), lists.flatten().to_numpy().astype(np.int64)
