"""A Merkle tree over documents, with a proof for every leaf.

The tree is swept by time-forward processing. Nodes are labelled by (level, place); a priority queue ordered by label
delivers the digests of children to their parent, and the reversed sweep delivers to every node the siblings met on the way
from it to the root, its proof suffix. The queue is external: between blocks of RUN ** DEEP nodes the messages lie in sorted
exchanges, one round for DEEP levels, and within a block, whose size is bounded, in a heap. No task holds more than a block,
whatever the size of a language.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampletide.llm.common import travels

travels(__name__)

RUN, DEEP = 8, 4
BLOCK = RUN ** DEEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_EVERY = 3
_ROWS = 2_000

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(nodes: int) -> int:
    """Levels above `nodes` nodes until one remains."""
    above = 0
    while nodes > 1:
        nodes, above = -(-nodes // RUN), above + 1
    return above


def leaf(*fields: Column) -> Column:
    """Digest of the fields, each a dash if null, else its UTF-8 length, a colon and its value."""
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, key, leaf, changed: the digest of each row and that of its tampered form (null where nobody tampers)."""
    other = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % TAMPERED_EVERY == 0
    fields = [F.col(c) for c in FIELDS]
    altered = leaf(*fields[:-1], F.translate(F.col("text"), CAPITALS, SMALL))
    # The key keeps the order of languages, null first, without being null itself.
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("key"),
                       leaf(*fields).alias("leaf"), F.when(other, altered).alias("changed"))


# --- rows in order, streamed -----------------------------------------------------------------------------

def _streamed(rows: DataFrame, keys: list[str], order: list, task, schema: str) -> DataFrame:
    """`task(key, rows) -> rows` for every group of `keys`, which must be small; `rows` are dicts in `order`."""
    names = rows.columns
    fields = rows.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    out = to_arrow_schema(fields)

    def run(batches):
        def one_by_one():
            for batch in batches:
                yield from zip(*(batch.column(names.index(n)).to_pylist() for n in names), strict=True)
        places = [names.index(k) for k in keys]
        held, group, made = [], None, []
        for row in one_by_one():
            key = tuple(row[p] for p in places)
            if key != group and held:
                made.extend(task(group, held))
                held = []
            group = key
            held.append(row)
            while len(made) >= _ROWS:
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in made[:_ROWS]], schema=out)
                made = made[_ROWS:]
        if held:
            made.extend(task(group, held))
        for i in range(0, len(made), _ROWS):
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in made[i:i + _ROWS]], schema=out)
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, fields)


def numbered(rows: DataFrame, order: list[str], written, name: str) -> DataFrame:
    """`rows` (with `key`) and place, total: their place among the rows of their key in `order`, and how many those are.

    Rows are dealt by ranges of key and order, so a key with most rows is spread; ranges are counted and added up.
    """
    ordered = [F.col("key"), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    fields = dealt.select("*", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("at")).schema
    at_key = rows.columns.index("key")

    def run(batches):
        from pyspark import TaskContext
        part, key, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for k in batch.column(at_key).to_pylist():
                n = n + 1 if k == key else 0
                key = k
                places.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(places), pa.int64()), pa.array(places, pa.int64())],
                                             names=[*batch.schema.names, "part", "at"])
    table = written(dealt.mapInArrow(run, fields), f"merkle-{name}")
    counted = table.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per key and range: a window holds as many rows of a key as there are ranges.
    by = Window.partitionBy("key")
    before = counted.select("key", "part", (F.sum("n").over(by.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(by).alias("total"))
    return (table.join(written(before, f"merkle-{name}-ranges"), ["key", "part"])
            .select(*rows.columns, (F.col("at") + F.col("before")).alias("place"), "total"))


# --- one block -------------------------------------------------------------------------------------------

def swept(digests: list[str], depth: int) -> tuple[str, dict]:
    """Top digest of a block and the children of each of its nodes by label (level, node)."""
    if not depth:
        return digests[0], {}
    queue = [(1, i // RUN, i % RUN, d) for i, d in enumerate(digests)]
    children: dict = {}
    while True:
        level, node = queue[0][:2]
        own = []
        while queue and queue[0][:2] == (level, node):
            own.append(heapq.heappop(queue)[3])
        children[level, node] = own
        made = digest("".join(own))
        if level == depth:
            return made, children
        heapq.heappush(queue, (level + 1, node // RUN, node % RUN, made))


def suffixes(children: dict, depth: int) -> dict:
    """Of every node of the lowest level, the siblings on the way up: a chain of (left, right, chain of the parent)."""
    queue: list = [(-depth, 0, None)]
    found = {}
    while queue:
        level, node, chain = heapq.heappop(queue)
        if not level:
            found[node] = chain
            continue
        own = children[-level, node]
        for i in range(len(own)):
            heapq.heappush(queue, (level + 1, node * RUN + i, ("".join(own[:i]), "".join(own[i + 1:]), chain)))
    return found


def unrolled(chain, above: str) -> list[tuple[str, str]]:
    """(left, right) of every level from a node to the root. `above` is the text form of the levels over its block."""
    out = []
    while chain:
        out.append(chain[:2])
        chain = chain[2]
    return out + [tuple(x.split("|")) for x in above.split(",") if x]


def folded(start: str, proof: list[tuple[str, str]]) -> str:
    for left, right in proof:
        start = digest(left + start + right)
    return start


# --- sweeps ----------------------------------------------------------------------------------------------

def _upward(nodes: DataFrame, written, name: str) -> list[DataFrame]:
    """Tables of key, place, total, digest: the given nodes, then every DEEP-th level, last one node of each key."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    tables, height = [nodes], levels(most)

    def task(group, rows):
        total = rows[0][2]
        return [(group[0], group[1], -(-total // BLOCK), swept([r[3] for r in rows], min(DEEP, levels(total)))[0])]
    for r in range(-(-height // DEEP)):
        own = tables[-1].select("key", "place", "total", "digest", F.expr(f"place div {BLOCK}").alias("block"))
        tables.append(written(_streamed(own, ["key", "block"], ["place"], task, "key string, place long, total long, digest string"), f"merkle-{name}-{r}"))
    return tables


def _with_header(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes by block, each block led by the row of its own node in `tops` (key, place, suffix, subroot)."""
    own = nodes.withColumn("block", F.expr(f"place div {BLOCK}"))
    head = tops.select("key", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "suffix", "subroot")
    return own.unionByName(head, allowMissingColumns=True)


def _downward(tables: list[DataFrame], tops: DataFrame, written, name: str, last: int = 0) -> DataFrame:
    """key, place, suffix, subroot of the nodes of `tables[last]`, from those of the one node of each key."""
    def task(group, rows):
        above, subroot = rows[0][4:6]
        own = rows[1:]
        depth = min(DEEP, levels(own[0][2]))
        found = suffixes(swept([r[3] for r in own], depth)[1], depth)
        for i, r in enumerate(own):
            yield group[0], r[1], ",".join("|".join(x) for x in unrolled(found[i], above)), subroot
    for r in reversed(range(last, len(tables) - 1)):
        both = _with_header(tables[r].select("key", "place", "total", "digest"), tops).select("key", "place", "total", "digest", "suffix", "subroot", "block")
        tops = written(_streamed(both, ["key", "block"], ["place"], task, "key string, place long, suffix string, subroot string"), f"merkle-{name}-down-{r}")
    return tops


class Tree:
    """Leaves by language and place, the sweeps above them, and the root (None without documents)."""

    def __init__(self, docs: DataFrame, written):
        self.written = written
        # The table is read for its digests once; what follows are rows of fixed size.
        self.leaves = written(numbered(written(leaves(docs), "merkle-leaves"), ["doc_id", "leaf"], written, "leaves"), "merkle-placed")
        self.parts = _upward(self.leaves.select("key", "place", "total", F.col("leaf").alias("digest")), written, "lang")
        subroots = self.parts[-1].select(F.col("key").alias("lang_key"), F.col("digest"), F.lit("").alias("key"))
        self.subroots = written(numbered(subroots, ["lang_key"], written, "subroots"), "merkle-subroots")
        self.whole = _upward(self.subroots.select("key", "place", "total", "digest"), written, "root")
        top = self.whole[-1].first()
        self.root = top["digest"] if top else None

    def manifest(self) -> DataFrame:
        """lang, n_documents, subroot, root: one row per language."""
        counted = self.leaves.groupBy("key", "lang").agg(F.count(F.lit(1)).alias("n_documents"))
        own = self.subroots.select(F.col("lang_key").alias("key"), F.col("digest").alias("subroot"))
        return counted.join(own, "key").select("lang", "n_documents", "subroot", F.lit(self.root).alias("root"))

    def proofs(self, full: bool = False) -> DataFrame:
        """doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified; with `full`, the proof as text too:
        levels parted by commas, siblings left and right of the path parted by a bar."""
        end = self.whole[-1].select("key", "place", F.lit("").alias("suffix"), F.lit("").alias("subroot"))
        tops = _downward(self.whole, end, self.written, "root").select("place", "suffix")
        own = self.subroots.join(tops, "place").select(F.col("lang_key").alias("key"), F.lit(0).cast("long").alias("place"), "suffix", F.col("digest").alias("subroot"))
        blocks = _downward(self.parts, own, self.written, "lang", 1) if len(self.parts) > 1 else own
        root, width = self.root, 1 if full else 0
        # A language of one leaf has no level of its own, its block is the leaf.
        both = _with_header(self.leaves, blocks).select("key", "place", "total", "leaf", "suffix", "subroot", "doc_id", "lang", "changed", "block")

        def task(group, rows):
            above, subroot = rows[0][4:6]
            own = rows[1:]
            depth = min(DEEP, levels(own[0][2]))
            found = suffixes(swept([r[3] for r in own], depth)[1], depth)
            for i, (_, _, _, node, _, _, doc_id, lang, changed, _) in enumerate(own):
                proof = unrolled(found[i], above)
                reached = folded(changed or node, proof)
                row = (doc_id, lang, node, subroot, root, digest("".join(a + b for a, b in proof)), reached, reached == root)
                yield row + (",".join("|".join(x) for x in proof),) * width
        schema = f"doc_id {self.leaves.schema['doc_id'].dataType.simpleString()}, lang string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return _streamed(both, ["key", "block"], ["place"], task, schema + ", proof string" * width)


def verified(docs: DataFrame, written) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (and lang); one row per row of `docs`.

    Nulls of any column are part of the leaf as dashes; a null language is a group of its own, before all others. Rows are
    ordered by id, null ids first, and rows that share an id by their digest, so repeated rows are equal leaves side by
    side. Null ids are never tampered with. An empty table has no root and gives no rows; other columns are not read.
    """
    tree = Tree(docs.select(*FIELDS), written)
    return tree.proofs().select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang")


# The tree in SQL: RUN nodes of a level become one of the next, twelve levels, far more than any table here has.
def _levels_sql(first: str, group: str, name: str, count: int = 12) -> str:
    out = [f"{name}0 AS ({first})"]
    for i in range(count):
        out.append(f"""
{name}{i}s AS (SELECT *, place // {RUN} AS up, count(*) OVER (PARTITION BY {group}) AS n FROM {name}{i}),
{name}{i + 1} AS (SELECT {group}, up AS place, CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest
  FROM {name}{i}s GROUP BY {group}, up)""")
    return ",".join(out)


def _part(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_part(c) for c in (*FIELDS[:-1], text)) + ")"


_CRC_STEP = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit."""
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST(ascii(substr({text}, CAST(i AS BIGINT), 1)) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {_CRC_STEP}), 4294967295)"


def _siblings_sql(name: str, group: str, count: int = 12) -> str:
    """Siblings left and right of every node of the levels that have more than one."""
    return " UNION ALL ".join(
        f"""SELECT {i} AS level, {group}, place,
  coalesce(string_agg(digest, '') OVER (PARTITION BY {group}, up ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(digest, '') OVER (PARTITION BY {group}, up ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{i}s WHERE n > 1""" for i in range(count))


VERIFIED_SQL = f"""
WITH RECURSIVE marked AS (SELECT doc_id, coalesce('=' || lang, '') AS key, lang, {_leaf_sql("text")} AS leaf,
  CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % {TAMPERED_EVERY} = 0 THEN {_leaf_sql(f"translate(text, '{CAPITALS}', '{SMALL}')")} END AS changed
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM marked),
{_levels_sql("SELECT key, place, leaf AS digest FROM placed", "key", "a")},
subroots AS (SELECT key AS lang_key, digest, row_number() OVER (ORDER BY key) - 1 AS place FROM a12),
{_levels_sql("SELECT 0 AS one, place, digest FROM subroots", "one", "b")},
steps AS MATERIALIZED (SELECT level, key, place, before, after FROM ({_siblings_sql("a", "key")})
  UNION ALL SELECT 12 + level, '', place, before, after FROM ({_siblings_sql("b", "one")})),
paths AS (SELECT doc_id, key, place, level FROM (SELECT p.doc_id, p.key, p.place // CAST(power({RUN}, l) AS BIGINT) AS place, l AS level FROM placed p, range(12) r(l))
  UNION ALL SELECT p.doc_id, '' AS key, s.place // CAST(power({RUN}, l) AS BIGINT), 12 + l FROM placed p JOIN subroots s ON s.lang_key = p.key, range(12) r(l)),
proofs AS (SELECT doc_id, list(struct_pack(b := before, a := after) ORDER BY level) AS steps FROM paths JOIN steps USING (level, key, place) GROUP BY doc_id),
walk AS (SELECT p.doc_id, coalesce(p.changed, p.leaf) AS digest, q.steps, 1 AS i FROM placed p LEFT JOIN proofs q USING (doc_id)
  UNION ALL SELECT doc_id, sha256(steps[i].b || digest || steps[i].a), steps, i + 1 FROM walk WHERE i <= len(steps)),
ends AS (SELECT doc_id, digest, steps FROM walk WHERE i > coalesce(len(steps), 0))
SELECT p.doc_id, p.leaf, s.digest AS subroot, b12.digest AS root,
  sha256(coalesce(array_to_string(list_transform(e.steps, lambda x: x.b || x.a), ''), '')) AS proof_sha256,
  e.digest AS folded_root, e.digest = b12.digest AS verified, p.lang
FROM placed p JOIN subroots s ON s.lang_key = p.key JOIN ends e USING (doc_id), b12
"""
