"""Mixing sources to target weights.

Words are summed per source; targets follow weights, capped at a multiple of what a source holds, the excess shared by
weight among the others. The repetition rate of a source is target / words: every document is taken floor(rate) times
and once more if a hash of its id, source and size, read as a number from 0 to 1, is below the fraction. The hash gives
DRAWS such numbers; a source uses the one whose words come nearest its target, summed for all of them in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import WORD_REGEX

WEIGHTS, MOST, SEED, DRAWS = (1, 2, 3), 3, "mix-1", 24


def _key():
    """Null sources are one source; its key cannot be a source's, which all begin with 's'."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, source_key, size (words; null text: 0) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       _key().alias("source_key"),
                       F.coalesce(F.regexp_count("text", F.lit(WORD_REGEX)), F.lit(0)).cast("long").alias("size"))


def ranked(names: DataFrame, written) -> DataFrame:
    """`names` with `rank` from 0 by source, null last. Sorted ranges are written, then numbered range by range."""
    parts = written(names.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix-sources")
    from pyspark.sql import Window
    before = (parts.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parts.withColumn("inside", inside).join(before, "part").withColumn("rank", F.col("before") + F.col("inside") - 1).drop("part", "inside", "n", "before")


def targets(sizes: DataFrame, written, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """source_key, source_size, weight, target: one row per source.

    A source keeps the level `level * weight` or its cap. Sources at their cap leave the others more, which can put
    more of them there: the level is worked out anew until no source is added. Each round is one sum over sources.
    """
    sources = sizes.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = written(ranked(sources, written).withColumn("weight", weight), "mix-weights")
    cap = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        full = F.lit(False) if held < 0 else F.col("weight") * F.lit(level) > cap
        now = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("caps"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("rest"),
                          F.count(F.when(full, 1)).alias("held")).first()
        if now.held == held or not now.rest:
            break
        held, level = now.held, (total - now.caps) / now.rest
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def copies(rate, digest, draw):
    """floor(rate) plus one where draw number `draw` of the digest (hexadecimal text) is below the fraction."""
    number = F.conv(F.substr(digest, draw + 1, F.lit(8)), 16, 10).cast("long") / F.lit(float(16 ** 8))
    whole = F.floor(rate)
    return (whole + F.when(number < rate - whole, 1).otherwise(0)).cast("long")


def _rate(most: int):
    return F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))


def _digest(seed: str):
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "source_key", F.col("size").cast("string")))


def planned(docs: DataFrame, written, weights, most: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows, and source_key, source_size, target, draw of every source."""
    sizes = written(sized(docs), "mix-sizes")
    plan = written(targets(sizes, written, weights, most).select("source_key", "source_size", "target"), "mix-targets")
    rows = sizes.join(plan, "source_key").withColumn("digest", _digest(seed))
    sums = rows.groupBy("source_key", "source_size", "target").agg(
        F.array(*[F.sum(copies(_rate(most), F.col("digest"), F.lit(k)) * F.col("size")) for k in range(DRAWS)]).alias("words"))
    off = F.transform("words", lambda w: F.abs(w - F.col("target")))
    nearest = (F.array_position(off, F.array_min(off)) - 1).cast("int")
    return sizes, written(sums.select("source_key", "source_size", "target", nearest.alias("draw")), "mix-draws")


def taken(docs: DataFrame, written, weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), copies; one row per row of `docs`.

    Null sources are one source, last in order. Null and empty texts have size 0 and take nothing. Rows alike in id,
    source and size share their draw. Sources without words get target 0. An empty table gives none. Other columns
    are not read.
    """
    sizes, plan = planned(docs, written, weights, most, seed)
    drawn = sizes.join(plan, "source_key").withColumn("copies", copies(_rate(most), _digest(seed), F.col("draw")))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, written, weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The rows of `docs`, each as often as it is taken; all columns stay.

    The draw uses the same values as `taken`. Rates are one row per source and meet documents in a plain join.
    """
    _, plan = planned(docs, written, weights, most, seed)
    columns = docs.columns
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _key().alias("source_key"),
                      F.coalesce(F.regexp_count("text", F.lit(WORD_REGEX)), F.lit(0)).cast("long").alias("size"))
    drawn = own.join(plan, "source_key").withColumn("copies", copies(_rate(most), _digest(seed), F.col("draw")))
    return (drawn.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in columns]))


TAKEN_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD_REGEX}')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sizes GROUP BY source),
sorted AS (
  SELECT *, coalesce(sum(3 * s) OVER o, 0) AS caps, sum(w) OVER (ORDER BY 3 * s / w, w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(s) OVER () AS total
  FROM sources WINDOW o AS (ORDER BY 3 * s / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT (total - caps)::BIGINT / rest::DOUBLE AS level, 3 * s / w >= (total - caps) / rest AS holds, caps FROM sorted),
level AS (SELECT coalesce(min_by(level, caps) FILTER (holds), 0) AS level FROM levels),
targets AS (SELECT source, s, least((3 * s)::DOUBLE, w * level) AS target FROM sources, level),
hashed AS (
  SELECT doc_id, size, d.source, s, target, CASE WHEN s > 0 THEN least(target / s, 3.0::DOUBLE) ELSE 0.0 END AS rate,
         md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, ''), coalesce('s' || d.source, ''), size::VARCHAR)) AS digest
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT *, k, (floor(rate) + CASE WHEN ('0x' || substr(digest, k + 1, 8))::BIGINT / {16 ** 8}.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM hashed, (SELECT unnest(range({DRAWS}))::INTEGER AS k)),
nearest AS (
  SELECT source, k FROM (SELECT source, k, abs(sum(copies * size) - target) AS off FROM drawn GROUP BY source, k, target)
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, k) = 1)
SELECT doc_id, size, s AS source_size, target, (copies * size)::BIGINT AS taken, copies
FROM drawn d JOIN nearest n ON d.source IS NOT DISTINCT FROM n.source AND d.k = n.k
"""
