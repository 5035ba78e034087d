"""Reachability over the multi-parent edges of lineage: ancestors, descendants, roots.

A record may have several parents, so parentage beyond the layers of an id is a graph. It is followed in semi-naive rounds:
only pairs found in the last round are joined with the edges, and only pairs not found before stay. Cycles therefore end
by themselves. There are as many rounds as the longest of the shortest paths, each a written table.

`totals` answers what only counts and ends of the pairs are wanted for. Where the core of the edges is small it is walked by
`funnel`. Otherwise ids are numbered so that neighbours in some order share a word, and what an id reaches in a number of steps is
a set of words with a bit per id. A round joins edges with words and not with ids, and takes them together by bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampletide.operators import funnel
from sampletide.operators.running import running
from sampletide.session import materialise

# Edges of one id that a task should meet; an id with more has its edges dealt over slots.
SLOT = 100_000
# Ids of a word: the bits of a BIGINT without its sign.
BITS = 63
# Ids or words sent to every task to leave out rows, and ids whose words are sent: eight bytes each.
FEW = 100_000
KNOWN = 2_000_000


def _dealt(edges: DataFrame, at: str, to: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(at, slot, to) without repetitions, and (at, slots) of the ids with more than one slot, or None."""
    links = materialise(edges.select(F.col(at).alias("at"), F.col(to).alias("to")).where("at is not null and to is not null").distinct(), "edges")
    hot = links.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("slots")).where("slots > 1")
    hot = materialise(hot, "hot-edges")
    if hot.isEmpty():
        return links.withColumn("slot", F.lit(0)), None
    spread = links.join(hot, "at", "left").select("at", "to", F.coalesce(F.pmod(F.xxhash64("to"), F.col("slots")), F.lit(0)).cast("int").alias("slot"))
    return materialise(spread, "dealt-edges"), hot


def reached(edges: DataFrame, ids: DataFrame, upward: bool = True, most: int = SLOT) -> DataFrame:
    """(lid, reached_lid, steps): every id that an id of `ids` (lid) reaches over `edges` (child_lid, parent_lid), with the
    fewest steps to it. Upward finds ancestors, downward descendants. An id on a cycle reaches itself; ids without
    edges reach nothing."""
    links, hot = _dealt(edges, *(("child_lid", "parent_lid") if upward else ("parent_lid", "child_lid")), most)
    found: list[DataFrame] = []
    front = ids.select("lid", F.col("lid").alias("node")).where("lid is not null").distinct()
    while True:
        front = front.withColumn("slot", F.lit(0))
        if hot is not None:
            front = front.join(hot.withColumnRenamed("at", "node"), "node", "left").withColumn(
                "slot", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slots") - 1, F.lit(0)))))
        step = front.join(links, (F.col("node") == F.col("at")) & (front["slot"] == links["slot"])).select("lid", F.col("to").alias("node")).distinct()
        if found:
            step = step.join(reduce(DataFrame.unionByName, found), ["lid", "node"], "left_anti")
        front = materialise(step, "closure")
        if front.isEmpty():
            break
        found.append(front)
    if not found:
        return ids.select("lid", F.col("lid").alias("reached_lid"), F.lit(1).alias("steps")).limit(0)
    return reduce(DataFrame.unionByName, [t.select("lid", F.col("node").alias("reached_lid"), F.lit(i + 1).alias("steps")) for i, t in enumerate(found)])


def ancestors(edges: DataFrame, ids: DataFrame, most: int = SLOT) -> DataFrame:
    return reached(edges, ids, True, most).withColumnRenamed("reached_lid", "ancestor_lid")


def descendants(edges: DataFrame, ids: DataFrame, most: int = SLOT) -> DataFrame:
    return reached(edges, ids, False, most).withColumnRenamed("reached_lid", "descendant_lid")


def roots(edges: DataFrame, ids: DataFrame, most: int = SLOT) -> DataFrame:
    """(lid, root_lid, steps): the ancestors that have no parent themselves, what a derived record was made from."""
    above = ancestors(edges, ids, most).withColumnRenamed("ancestor_lid", "root_lid")
    parents = edges.select(F.col("child_lid").alias("root_lid")).distinct()
    return above.join(parents, "root_lid", "left_anti").select("lid", "root_lid", "steps")


def _spread(front: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Rows (node and others) with `slot`, once per slot of their node's edges."""
    if hot is None:
        return front.withColumn("slot", F.lit(0))
    slots = F.sequence(F.lit(0), F.coalesce(F.col("slots") - 1, F.lit(0)))
    return front.join(hot.withColumnRenamed("at", "node"), "node", "left").withColumn("slot", F.explode(slots)).drop("slots")


def _numbered(ids: DataFrame, near: list[str]) -> DataFrame:
    """(lid, rank, word, bit) of different ids: the rank is the place in order of ids. A word has up to 63 ids that follow one another
    in the order of `near` and then of ids; inside it, bits are in order of ids."""
    ranked = running(ids, ["lid"], {"rank": F.lit(1).cast("bigint")}).withColumn("rank", F.col("rank") - 1)
    if not near:
        return ranked.withColumns({"word": F.floor(F.col("rank") / BITS).cast("bigint"), "bit": F.pmod("rank", F.lit(BITS)).cast("int")})
    names = [f"_near{i}" for i in range(len(near))]
    placed = running(ranked.withColumns({n: F.expr(e) for n, e in zip(names, near, strict=True)}), [*names, "lid"], {"place": F.lit(1).cast("bigint")})
    inside = Window.partitionBy("word").orderBy("rank")
    return placed.withColumn("word", F.floor((F.col("place") - 1) / BITS).cast("bigint")).select("lid", "rank", "word", (F.row_number().over(inside) - 1).alias("bit"))


def _exact(links: DataFrame, most: int) -> list[DataFrame]:
    """(node, word, bits) per number of steps: what a node reaches in just so many and not fewer, over links (at, to, word, bit)."""
    dealt, hot = _dealt(links, "to", "at", most)
    front = materialise(links.groupBy(F.col("at").alias("node"), "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")), "sets")
    found: list[DataFrame] = []
    while not front.isEmpty():
        found.append(front)
        # What a node reaches in one step more is what the ends of its edges reach, without what it has by then.
        step = _spread(front, hot).join(dealt.withColumnsRenamed({"slot": "_slot"}), (F.col("node") == F.col("at")) & (F.col("slot") == F.col("_slot")))
        step = materialise(step.groupBy(F.col("to").alias("node"), "word").agg(F.bit_or("bits").alias("bits")), "step")
        old = reduce(DataFrame.unionByName, found)
        sizes = step.agg(*[F.approx_count_distinct(c).alias(c) for c in ("node", "word")]).first()
        for key in ("node", "word"):
            if sizes[key] <= FEW:
                old = old.join(F.broadcast(step.select(key).distinct()), key, "left_semi")
        old = old.groupBy("node", "word").agg(F.bit_or("bits").alias("old"))
        fresh = step.join(old, ["node", "word"], "left").select("node", "word", F.expr("bits & ~coalesce(old, 0L)").alias("bits"))
        front = materialise(fresh.where("bits <> 0"), "sets")
    return found


def totals(edges: DataFrame, ids: DataFrame, upward: bool = True, near: list[str] | None = None, only_roots: bool = False, most: int = SLOT, core: int = funnel.CORE) -> DataFrame:
    """(lid, steps, n, first, last): how many ids an id of `ids` (lid) reaches in so many steps and no fewer, and the first and last of
    them in order: `reached`, counted, without a row per pair. With `only_roots` just those that have no edge on are counted.

    `near` has SQL expressions of `lid` in whose order ids reached together lie together; results do not depend on it, the size of
    the sets does. The sets of all ids with edges are found, as they are made of one another; for a few ids `reached` does less.
    Where the core of the edges has up to `core` ids it is walked by `funnel`, which keeps no sets of the others.
    """
    walked = funnel.totals(edges, ids, upward, near, only_roots, core)
    return _by_words(edges, ids, upward, near, only_roots, most) if walked is None else walked


def _by_words(edges: DataFrame, ids: DataFrame, upward: bool, near: list[str] | None, only_roots: bool, most: int) -> DataFrame:
    """The totals by sets of words."""
    at, to = ("child_lid", "parent_lid") if upward else ("parent_lid", "child_lid")
    raw = edges.select(F.col(at).alias("at"), F.col(to).alias("to")).where("at is not null and to is not null")
    starts = ids.select("lid").where("lid is not null")
    every = raw.select(F.explode(F.array("at", "to")).alias("lid")).unionByName(starts).distinct()
    nodes = materialise(_numbered(every, near or []), "numbered")
    ends = nodes.select(F.col("lid").alias("to"), F.col("rank").alias("to_rank"), "word", "bit")
    links = raw.join(nodes.select(F.col("lid").alias("at"), F.col("rank").alias("at_rank")), "at").join(ends, "to")
    links = materialise(links.select(F.col("at_rank").alias("at"), F.col("to_rank").alias("to"), "word", "bit").distinct(), "links")
    found = _exact(links, most)
    if not found:
        return ids.select("lid", F.lit(1).alias("steps"), F.lit(0).cast("bigint").alias("n"), F.col("lid").alias("first"), F.col("lid").alias("last")).limit(0)
    wanted = nodes
    if only_roots:
        wanted = nodes.join(links.select(F.col("at").alias("rank")).distinct(), "rank", "left_anti").select(*nodes.columns)
    # The ids of a word in the order of its bits; bits of ids that are not wanted have none.
    wanted = wanted.join(links.select(F.col("to").alias("rank")).distinct(), "rank", "left_semi")
    words = wanted.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"), F.map_from_entries(F.collect_list(F.struct("bit", "rank"))).alias("ranks"))
    words = materialise(words, "words")
    if wanted.count() <= KNOWN:
        words = F.broadcast(words)
    sets = reduce(DataFrame.unionByName, [t.withColumn("steps", F.lit(i + 1)) for i, t in enumerate(found)])
    sets = sets.join(words, "word").withColumn("bits", F.col("bits").bitwiseAND(F.col("mask"))).where("bits <> 0")
    counted = sets.select("node", "steps", F.bit_count("bits").cast("bigint").alias("n"), F.expr("ranks[cast(bit_count((bits & -bits) - 1) as int)]").alias("first"),
                          F.expr("ranks[length(bin(bits)) - 1]").alias("last"))
    counted = counted.groupBy("node", "steps").agg(F.sum("n").alias("n"), F.min("first").alias("_first"), F.max("last").alias("_last"))
    named = counted.join(nodes.join(starts, "lid", "left_semi").select("lid", F.col("rank").alias("node")), "node")
    for end in ("first", "last"):
        named = named.join(nodes.select(F.col("lid").alias(end), F.col("rank").alias(f"_{end}")), f"_{end}")
    return named.select("lid", "steps", "n", "first", "last")
