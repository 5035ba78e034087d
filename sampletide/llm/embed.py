"""Near-duplicate vectors by an exact metric range join.

Vectors are scaled to length one, where cosine s is the distance sqrt(2 - 2 s). Pivots, drawn from the vectors by hash,
part them into cells; a vector lives in the cell of its nearest pivot. Two bounds from the triangle inequality say
which other cells can hold a vector in range: the cell's radius (d(x, p) <= radius + range), and the plane between the
pivots ((d(x, p)^2 - d(x, home)^2) / (2 d(p, home)) <= range). A vector is replicated to the cells that both allow, and
cells are joined independently. A full cell is cut into blocks by hash, so no task holds more than a block while the
vectors in reach stream past it. Products are taken in single precision and, near the threshold, again in double.

Equal vectors are one class, compared once with the number of its ids as weight, so copies cost nothing. Links are counted
where a class lives; of the links themselves only what keeps components together is handed on: one row per linked class and
block. Ids with several vectors are rare: for classes that hold one, links are handed on one by one, to count each id once.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import mapped, travels
from sampletide.llm.components import connected

travels(__name__)

COSINE = 0.95
# Vectors of a cell's block, vectors a cell should hold, most pivots (bounds what goes to every task).
BLOCK, CELL, MOST_PIVOTS = 8192, 8192, 4096
# Single-precision products of unit vectors err by less than this; distances get the same slack.
DOUBT = 1e-4


def matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists(rows: np.ndarray):
    import pyarrow as pa
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the rows that can link: an id, and a vector of finite components, not all 0."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))


def pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """Unit vectors of the rows with the smallest hashes: at most MOST_PIVOTS rows come to the driver. Pivots nearer to
    each other than the range are no use twice: a dense group gives one."""
    count = max(1, min(MOST_PIVOTS, -(-n // CELL)))
    drawn = vectors.select("embedding", F.xxhash64("vec_id", F.lit(11)).alias("h"), "vec_id").orderBy("h", "vec_id").limit(4 * count).select("embedding").collect()
    rows = np.array([unit(np.array(r.embedding)[None])[0] for r in drawn])
    taken, kept = np.zeros(len(rows), bool), []
    for i in range(len(rows)):
        if not taken[i] and len(kept) < count:
            kept.append(i)
            taken |= rows @ rows[i] >= COSINE
    return rows[kept]


def unit(rows: np.ndarray) -> np.ndarray:
    top = np.abs(rows).max(1, keepdims=True)  # before squaring, lest huge or tiny components leave the range of doubles
    rows = rows / top
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def homes(vectors: DataFrame, points: np.ndarray, dim: int) -> DataFrame:
    """vec_id, weight, several, embedding, home, distance (to the home pivot)."""
    def task(columns):
        rows = unit(matrix(columns["embedding"]))
        near = rows @ points.T
        home = near.argmax(1)
        return {c: columns[c] for c in ("vec_id", "weight", "several", "embedding")} | {"home": home,
                "distance": np.sqrt(np.maximum(2 - 2 * near[np.arange(len(rows)), home], 0))}
    return mapped(vectors.where(F.size("embedding") == dim), task, "vec_id long, weight long, several boolean, embedding array<double>, home int, distance double")


def reached(placed: DataFrame, points: np.ndarray, radius: dict, cuts: dict, reach: float) -> DataFrame:
    """cell, block, passes (0: lives in this block, 1: passes by), vec_id, weight, several, embedding: a row for every block in reach."""
    between = np.sqrt(np.maximum(2 - 2 * points @ points.T, 0))
    radii = np.array([radius.get(i, -np.inf) for i in range(len(points))])

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                rows = matrix(batch.column(1))
                home = batch.column(2).to_numpy(zero_copy_only=False)
                squared = np.maximum(2 - 2 * unit(rows) @ points.T, 0)
                far = np.sqrt(squared)
                own = far[np.arange(len(rows)), home]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (squared - (own ** 2)[:, None]) / (2 * between[home])
                ok = (far <= radii[None] + reach) & ~(plane > reach)
                ok[np.arange(len(rows)), home] = True
                row, cell = np.nonzero(ok & np.isfinite(radii)[None])
                number = (ids[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64)
                for c in np.unique(cell):
                    here = row[cell == c]
                    lives = number[cell == c] % cuts[int(c)]
                    for block in range(cuts[int(c)]):
                        mine = (home[here] == c) & (lives == block)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(here), c), pa.int32()), pa.array(np.full(len(here), block), pa.int32()), pa.array((~mine).astype(np.int32)),
                             pa.array(ids[here]), *[batch.column(i).take(pa.array(here)) for i in (3, 4, 1)]],
                            names=["cell", "block", "passes", "vec_id", "weight", "several", "embedding"])
    return placed.select("vec_id", "embedding", "home", "weight", "several").mapInArrow(
        run, "cell int, block int, passes int, vec_id long, weight long, several boolean, embedding array<double>")


# Rows of a block's result: the weight linked to a class, two classes of one component, a link handed on.
COUNT, TIE, LINK = range(3)


class Block:
    """The classes that live in one block, the weight linked to each and their sets."""

    def __init__(self, cosine: float):
        self.cosine, self.parts = cosine, []
        self.ids = None

    def lives(self, *part: np.ndarray) -> None:
        """ids, weights, several, vectors."""
        self.parts.append(part)

    def settle(self) -> None:
        """Once all that live here are known, they pass each other first."""
        if self.ids is None:
            self.ids, weights, self.several, rows = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            self.rows = unit(rows)
            self.single, self.parts = self.rows.astype(np.float32), []
            self.links, self.label = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
            self.ties: list = []
            self.pairs: list = []
            for at in range(0, len(self.ids), 512):
                end = at + 512
                self._passes(self.ids[at:end], weights[at:end], self.several[at:end], self.rows[at:end])

    def passes(self, ids: np.ndarray, weights: np.ndarray, several: np.ndarray, rows: np.ndarray) -> None:
        self.settle()
        for at in range(0, len(ids), 512):
            end = at + 512
            self._passes(ids[at:end], weights[at:end], several[at:end], unit(rows[at:end]))

    def _passes(self, ids: np.ndarray, weights: np.ndarray, several: np.ndarray, rows: np.ndarray) -> None:
        near = rows.astype(np.float32) @ self.single.T
        linked = near >= self.cosine - DOUBT
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            return
        linked, near = linked[some], near[some]
        r, c = np.nonzero(linked & (near < self.cosine + DOUBT))
        for s in range(0, len(r), 100_000):  # in double where single precision cannot tell
            a, b = r[s:s + 100_000], c[s:s + 100_000]
            linked[a, b] = (rows[some[a]] * self.rows[b]).sum(1) >= self.cosine
        linked &= ids[some][:, None] != self.ids[None]
        r, c = np.nonzero(linked)
        np.add.at(self.links, c, weights[some[r]])
        shown = several[some[r]] | self.several[c]
        self.pairs.append(np.stack([self.ids[c[shown]], ids[some[r[shown]]]], 1))
        for i, row in zip(some.tolist(), linked, strict=True):
            mine = np.flatnonzero(row)
            if len(mine):
                labels = np.unique(self.label[mine])
                if len(labels) > 1:
                    self.label[np.isin(self.label, labels)] = labels[0]
                self.ties.append((int(ids[i]), int(self.ids[mine[0]])))

    def result(self):
        """(vec_id, links, other, kind)."""
        self.settle()
        moved = np.flatnonzero(self.label != np.arange(len(self.ids)))
        ties, pairs = np.array(self.ties, np.int64).reshape(-1, 2), np.concatenate([np.zeros((0, 2), np.int64), *self.pairs])
        ids = np.concatenate([self.ids, self.ids[moved], ties[:, 0], pairs[:, 0]])
        others = np.concatenate([self.ids, self.ids[self.label[moved]], ties[:, 1], pairs[:, 1]])
        kind = np.repeat([COUNT, TIE, LINK], [len(self.ids), len(moved) + len(ties), len(pairs)])
        return ids, np.concatenate([self.links, np.zeros(len(ids) - len(self.ids), np.int64)]), others, kind


def joined(groups: DataFrame, cosine: float) -> DataFrame:
    """vec_id, links, other, kind of every block; rows come sorted by cell, block and whether they pass by."""
    names = ["vec_id", "links", "other", "kind"]

    def run(batches):
        import pyarrow as pa
        block, key = None, None
        for batch in batches:
            cells, blocks, passing = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            more = [batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5)]
            code = (cells.astype(np.int64) << 33) + (blocks.astype(np.int64) << 1) + passing
            ends = [0, *(np.flatnonzero(np.diff(code)) + 1).tolist(), len(code)]
            for start, end in zip(ends, ends[1:], strict=False):
                if start == end:
                    continue
                if (cells[start], blocks[start]) != key:
                    if block is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in block.result()], names=names)
                    block, key = Block(cosine), (cells[start], blocks[start])
                part = (*(x[start:end] for x in more), matrix(batch.column(6).slice(start, end - start)))
                (block.passes if passing[start] else block.lives)(*part)
        if block is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in block.result()], names=names)
    return groups.mapInArrow(run, "vec_id long, links long, other long, kind long")


# Classes that hold more than one in HOT of all rows, of which there are fewer than HOT, are joined by a salt as well.
HOT, SALTS = 500, 64


def classes_of(vectors: DataFrame, written) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal vectors (class, embedding, low: least id, n: ids), members (vec_id, class), and the members that are
    ids with several vectors."""
    rows = written(usable(vectors).distinct(), "vectors")
    found = written(rows.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("n")), "vector-groups")
    # Numbers of rows of a written table: they do not change when it is read again.
    found = written(found.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    limit = max(1000, rows.count() // HOT)
    hot = found.where(F.col("n") > limit).select(F.col("embedding").alias("_e"), F.lit(True).alias("_hot"))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(hot), F.col("embedding") == F.col("_e"), "left").select("vec_id", "embedding", salt.alias("salt"))
    salts = F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    members = written(dealt.join(found.select("embedding", "class", F.explode(salts).alias("salt")), ["embedding", "salt"]).select("vec_id", "class"), "vector-members")
    several = members.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    return found, members, written(members.join(several, "vec_id"), "vectors-several")


def near_duplicates(vectors: DataFrame, written, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per row of `vectors`.

    Null, empty and zero vectors, those with null or non-finite components and rows without an id link with nothing:
    n_links 0, component_id their own id. Only vectors of one length are compared. An id with several vectors is linked to
    whatever one of them is linked to, and is counted once by others. A null id gives a null component_id, kept false.
    """
    classes, members, several = classes_of(vectors, written)
    held = several.groupBy(F.col("class").alias("_class")).agg(F.count("*").alias("k"))
    k = F.coalesce("k", F.lit(0))
    good = written(classes.join(held, F.col("class") == F.col("_class"), "left").select(
        F.col("class").alias("vec_id"), "embedding", "low", (F.col("n") - k).alias("weight"), (k > 0).alias("several")), "vector-weights")
    reach = math.sqrt(2 - 2 * cosine) + DOUBT
    results = []
    for dim, n in sorted((r[0], r[1]) for r in good.groupBy(F.size("embedding")).count().collect()):
        points = pivots(good.where(F.size("embedding") == dim), n)
        placed = written(homes(good, points, dim), "vectors-placed")
        cells = placed.groupBy("home").agg(F.max("distance").alias("radius"), F.count("*").alias("n")).collect()  # one row per pivot
        radius, cuts = {r.home: r.radius + DOUBT for r in cells}, {r.home: -(-r.n // BLOCK) for r in cells}
        groups = (reached(placed, points, radius, cuts, reach).repartition("cell", "block").sortWithinPartitions("cell", "block", "passes"))
        results.append(joined(groups, cosine))
    if not results:
        return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                              F.col("vec_id").cast("long").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = results[0]
    for r in results[1:]:
        found = found.unionByName(r)
    found = written(found, "vector-links")
    own = good.select(F.col("vec_id").alias("class"), "weight", "low")
    counts = found.where(f"kind = {COUNT}").groupBy(F.col("vec_id").alias("class")).agg(F.sum("links").alias("links")).join(own, "class")
    ties = found.where(f"kind = {TIE}").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    some = not several.isEmpty()
    if some:
        first = several.groupBy("vec_id").agg(F.min("class").alias("b"))
        ties = ties.unionByName(several.join(first, "vec_id").select(F.col("class").alias("a"), "b"))
    roots = connected(ties, written)
    rooted = written(counts.join(roots, F.col("node") == F.col("class"), "left").select("class", "weight", "links", "low", F.coalesce("root", "class").alias("root")), "vector-roots")
    least = rooted.groupBy("root").agg(F.min("low").alias("component"))
    label = written(rooted.join(least, "root").select("class", "weight", "links", "component"), "vector-components")
    alone = members.join(several.select("vec_id").distinct(), "vec_id", "left_anti") if some else members
    # Ids of one vector: all of the classes linked, and of their own class, but themselves.
    each = alone.join(label, "class").select("vec_id", "class", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component")
    if some:
        links = _with_own(found, several)
        others = links.join(several.select(F.col("class").alias("other"), F.col("vec_id").alias("_id")), "other")
        seen = others.select("class", "_id").distinct().groupBy("class").agg(F.count("*").alias("more"))
        each = each.join(seen, "class", "left").select("vec_id", (F.col("n_links") + F.coalesce("more", F.lit(0))).alias("n_links"), "component")
        mine = several.join(links, "class").select("vec_id", "other").distinct()
        plain = mine.join(own.select(F.col("class").alias("other"), "weight"), "other").groupBy("vec_id").agg(F.sum("weight").alias("plain"))
        again = mine.join(several.select(F.col("class").alias("other"), F.col("vec_id").alias("_id")), "other").where("_id <> vec_id").select(
            "vec_id", "_id").distinct().groupBy("vec_id").agg(F.count("*").alias("again"))
        component = several.join(label, "class").groupBy("vec_id").agg(F.min("component").alias("component"))
        each = each.unionByName(plain.join(again, "vec_id", "left").join(component, "vec_id").select(
            "vec_id", (F.col("plain") + F.coalesce("again", F.lit(0))).alias("n_links"), "component"))
    each = each.select(F.col("vec_id").alias("_id"), "n_links", "component")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    return (rows.join(each, F.col("_id") == rows["vec_id"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(False))))


def _with_own(found: DataFrame, several: DataFrame) -> DataFrame:
    """(class, other) of the links handed on, and every class with an id of several vectors with itself."""
    return (found.where(f"kind = {LINK}").select(F.col("vec_id").alias("class"), "other")
            .unionByName(several.select("class", F.col("class").alias("other"))).distinct())
