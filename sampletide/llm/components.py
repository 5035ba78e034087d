"""Connected components of a table of links, by alternating large and small stars.

Every round ties each node's greater neighbours to its smallest one, then its smaller neighbours to the smallest of
them, until all nodes hang on the smallest of their component. A round is two aggregates and two joins over the links
and is written, so lineage stays short; the driver sees a count and a checksum. Nodes with many links are salted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import travels

travels(__name__)


SALTS, HOT_NODES = 64, 1000


def with_least(links: DataFrame, key: str, other: str, least, written, n: int) -> DataFrame:
    """`links` with m, the least of `other` of each `key`.

    Nodes with more than 2 n / HOT_NODES of the n links are at most HOT_NODES, so that table may be broadcast. Their
    links are dealt by a salt as well, and their row of the least is there once for each salt.
    """
    found = written(links.groupBy(key).agg(least.alias("m"), F.count("*").alias("degree")), "least")
    limit = max(1000, 2 * n // HOT_NODES)
    hot = found.where(F.col("degree") > limit).select(F.col(key).alias("hot"))
    salts = F.when(F.col("degree") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = found.select(key, "m", F.explode(salts).alias("salt"))
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    return (links.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left").withColumn("salt", salt).drop("hot")
            .join(spread, [key, "salt"]).drop("salt"))


def connected(links: DataFrame, written) -> DataFrame:
    """node, root (smallest node of its component) of every node but the roots; `links` has long columns a and b."""
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        tied = with_least(both, "u", "v", F.least(F.min("v"), F.min("u")), written, 2 * state[0])
        large = written(tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "links")
        tied = with_least(large, "a", "b", F.min("b"), written, 2 * state[0])
        small = tied.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = written(small.distinct(), "links")


class Sets:
    """Disjoint sets of the numbers below n; the root is the smallest."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def join_all(self, linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Join rows[i] and columns[j] wherever linked[i, j]; no list of pairs is made."""
        for i in np.flatnonzero(linked.any(1)):
            r = self.root(int(rows[i]))
            for j in np.flatnonzero(linked[i]).tolist():
                c = self.root(int(columns[j]))
                if c != r:
                    self.up[max(r, c)] = min(r, c)
                    r = min(r, c)

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)


def groups_of(batches, keys: int):
    """Rows of sorted Arrow batches, one record batch per run of equal values in the first `keys` columns."""
    import pyarrow as pa
    held, last = [], None

    def joined(parts):
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        ends = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(ends, ends[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if held and key != last:
                yield joined(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield joined(held)
