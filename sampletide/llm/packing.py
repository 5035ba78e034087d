"""Best-fit packing of documents into sequences, with conflicts.

Bins have a fixed capacity in words. A bin carries a bitmap of its sources and one of its duplicate clusters; a piece
may not join a bin that holds its cluster, nor one that holds its source more often than allowed. Pieces come by
falling size. Open bins are kept ordered by what is left in them, and the search starts at the tightest that has room
and goes on to the next until one is compatible; if none is, a bin is opened.

Documents longer than a bin are cut: full pieces are bins of their own, the rest is packed. Pieces are dealt by hash
to groups of bounded size, which are packed independently; a source or cluster of any size is spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampletide.llm.common import WORD_REGEX, travels
from sampletide.llm.components import groups_of

travels(__name__)

CAPACITY, GROUP = 2048, 4096
# Pieces of one source a bin may hold: bitmaps count by one bit plane for each.
PER_SOURCE = 2


class Bins:
    """The bins of one group."""

    def __init__(self, capacity: int = CAPACITY, per_source: int = PER_SOURCE):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []  # (room, bin) of bins that are not full
        self.used: list[int] = []
        self.sources: list[list[int]] = []  # per bin, one bitmap for each time a source may be there
        self.clusters: list[int] = []

    def fits(self, number: int, source: int, cluster: int) -> bool:
        return not (self.clusters[number] & cluster or self.sources[number][-1] & source)

    def put(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and place in it of a piece; `source` and `cluster` have one bit, or none for a piece that cannot conflict."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order) and not self.fits(self.order[at][1], source, cluster):
            at += 1
        if at < len(self.order):
            room, number = self.order.pop(at)
        else:
            room, number = self.capacity, len(self.used)
            self.used.append(0)
            self.sources.append([0] * self.per_source)
            self.clusters.append(0)
        place = self.used[number]
        self.used[number] += size
        for plane in range(self.per_source):
            if not self.sources[number][plane] & source:
                self.sources[number][plane] |= source
                break
        self.clusters[number] |= cluster
        if room > size:
            insort(self.order, (room - size, number))
        return number, place


def bits(values) -> list[int]:
    """One bit for each value that occurs twice or more, no bit for the others and for null: they cannot conflict."""
    seen, many = set(), {}
    for v in values:
        if v is not None and v in seen and v not in many:
            many[v] = 1 << len(many)
        seen.add(v)
    return [many.get(v, 0) for v in values]


def packed(sizes, sources, clusters, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, place) of pieces given by falling size."""
    bins = Bins(capacity, per_source)
    return [bins.put(*piece) for piece in zip(sizes, bits(sources), bits(clusters), strict=True)]


def _repetitions(rows: DataFrame, written) -> DataFrame:
    """uid, k: the number of a row among those equal to it, for rows that have equals.

    Rows are numbered within the parts of the written table and the parts' counts are added up, so a row repeated endlessly
    is in no single task."""
    keys = ["doc_id", "source", "cluster"]
    same = lambda a, b: (a["doc_id"].eqNullSafe(b["_doc_id"])) & (a["source"].eqNullSafe(b["_source"])) & (a["cluster"] == b["_cluster"])
    named = {k: f"_{k}" for k in keys}
    again = written(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").withColumnsRenamed(named), "pack-repeated")
    held = rows.join(again, same(rows, again)).select("uid", *named.values(), F.shiftright("uid", 33).alias("part"))
    inside = F.row_number().over(Window.partitionBy(*named.values(), "part").orderBy("uid")) - 1
    held = written(held.withColumn("at", inside), "pack-repetitions")
    parts = held.groupBy(*named.values(), "part").agg(F.count("*").alias("n"))
    # As many rows of a key as the table has parts.
    before = F.sum("n").over(Window.partitionBy(*named.values()).orderBy("part")) - F.col("n")
    counted = parts.select("part", *[F.col(c).alias(f"_{c}") for c in named.values()], before.alias("before")).withColumnRenamed("part", "_part")
    on = F.col("part") == F.col("_part")
    for c in named.values():
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return held.join(counted, on).select("uid", (F.col("at") + F.col("before")).alias("k"))


def pieces(docs: DataFrame, written, capacity: int = CAPACITY) -> DataFrame:
    """uid, name, doc_id, source, cluster, piece, first_word, size, whole (a full bin by itself) of all documents with words.

    The cluster of a document is a digest of its text in lower case with single blanks. `uid` is a row's place in the written
    table; `name` is a digest of its id, source and cluster, and of which of its equals it is, so it does not depend on
    places."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD_REGEX)).cast("long").alias("n_words"),
        F.md5(F.regexp_replace(F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " ")), "^ | $", "")).alias("cluster"))
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()), "pack-documents")
    rows = rows.join(_repetitions(rows, written), "uid", "left").withColumn("name", F.md5(F.to_json(F.struct("doc_id", "source", "cluster", F.coalesce("k", F.lit(0)).alias("k")))))
    count = F.greatest(F.ceil(F.col("n_words") / capacity).cast("int"), F.lit(1))
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("first_word", F.col("piece").cast("long") * capacity)
    return (cut.withColumn("size", F.least(F.lit(capacity), F.col("n_words") - F.col("first_word")).cast("long"))
            .withColumn("whole", F.col("size") == capacity))


def pack(docs: DataFrame, written, capacity: int = CAPACITY, per_source: int = PER_SOURCE, group: int = GROUP) -> DataFrame:
    """doc_id, piece, first_word, n_words, bin_id, place (words before it in the bin): one row per piece.

    Documents without words take no room: one row with no bin. Null sources are in nobody's way; null ids and repeated
    rows are packed like others, but equal texts never share a bin. Ties go by document id, then by digest. An empty table
    gives no rows. Other columns are not read. Equal tables give equal bins, however they are partitioned.
    """
    cut = written(pieces(docs, written, capacity), "pack-pieces")
    rest = cut.where("not whole and size > 0")
    groups = max(1, -(-rest.count() // group))
    dealt = (rest.select(F.pmod(F.xxhash64("name", F.lit(5)), F.lit(groups)).alias("bunch"), (-F.col("size")).alias("falling"), "doc_id", "uid", "source", "cluster", "name")
             .repartition("bunch").sortWithinPartitions("bunch", "falling", F.col("doc_id").asc_nulls_first(), "name"))

    def run(batches):
        import pyarrow as pa
        for rows in groups_of(batches, 1):
            sizes = [-s for s in rows.column(1).to_pylist()]
            at = packed(sizes, rows.column(4).to_pylist(), rows.column(5).to_pylist(), capacity, per_source)
            yield pa.RecordBatch.from_arrays([rows.column(3), rows.column(0), pa.array([b for b, _ in at], pa.int64()), pa.array([p for _, p in at], pa.int64())],
                                             names=["uid", "bunch", "bin", "place"])
    placed = written(dealt.mapInArrow(run, "uid long, bunch long, bin long, place long"), "pack-placed")
    # The rest of a document is its last piece, so the row's number and that piece name it; full pieces name their own bin.
    both = cut.join(placed, (cut["uid"] == placed["uid"]) & ~cut["whole"], "left").select(
        "doc_id", "piece", "first_word", F.col("size").alias("n_words"),
        F.when(F.col("whole"), F.concat_ws("-", F.lit("w"), "name", F.col("piece").cast("string")))
        .when(F.col("bin").isNotNull(), F.concat_ws("-", F.lit("g"), F.col("bunch").cast("string"), F.col("bin").cast("string"))).alias("bin_id"),
        F.when(F.col("whole"), F.lit(0).cast("long")).otherwise(F.col("place")).alias("place"))
    return both
