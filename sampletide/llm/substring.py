"""Repeated passages across documents, by hashing their units.

Texts are cut into lines, paragraphs or sentences. Units are normalised and hashed to 128 bits; digests are grouped over
the whole corpus by partial aggregates, the occurrence with the smallest (doc_id, number of the unit) keeps its place,
and every other one is a repetition, with its original offsets. Neighbouring repetitions form a passage, which is
removed if it has words enough: a passage that stands in the midst of a line is found by the sentences it holds, and a
short stock phrase alone is left. Only digests that occur twice meet the units again, in a plain join.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampletide.llm.common import mapped, travels

travels(__name__)

# Words of a passage from which on it goes. A passage of 50 words in the midst of other text may lose its first and
# last sentence, which run on into what stands around it.
MIN_WORDS = 25
_PARTS = {
    "sentence": re.compile(r"[^.!?\n]*[.!?]*\n?"),
    "line": re.compile(r"[^\n]*\n?"),
    "paragraph": re.compile(r"(?:[^\n]+\n?)+\n*|\n+"),
}


def units(text: str | None, unit: str = "sentence"):
    """(number, start, stop, words in lower case) of the units that hold a word; offsets in code points, stop exclusive,
    line breaks at the end left out."""
    number = 0
    for m in _PARTS[unit].finditer(text or ""):
        found = unicodedata.normalize("NFC", m.group().lower()).split()
        if found:
            yield number, m.start(), m.start() + len(m.group().rstrip("\n")), found
            number += 1


def unit_rows(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """doc_id, unit, start, stop, words, digest of all units. Rows without an id take no part."""
    def task(columns):
        import xxhash
        out = {"doc_id": [], "unit": [], "start": [], "stop": [], "words": [], "digest": []}
        for doc_id, text in zip(columns["doc_id"].to_pylist(), columns["text"].to_pylist(), strict=True):
            for number, start, stop, found in units(text, unit):
                digest = xxhash.xxh3_128_digest(" ".join(found).encode("utf-8", "surrogatepass"))
                for name, value in zip(out, (doc_id, number, start, stop, len(found), digest), strict=True):
                    out[name].append(value)
        return out
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null"), task,
                  "doc_id long, unit int, start int, stop int, words int, digest binary")


def passages(docs: DataFrame, written, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, start, stop, n_words, n_units, first_docs: one row per passage that goes.

    first_docs are the documents that keep its units. Null and empty texts have no units. Rows that repeat an id are
    one document: what is alike in (doc_id, unit) is one occurrence. An empty table gives no rows. Other columns are
    not read. Neighbours are found by document, which a window sorts with spilling; a hot digest is no group there.
    """
    rows = written(unit_rows(docs, unit), "substring-units")
    firsts = (rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "unit")).alias("first"))
              .where("n > 1").select("digest", F.col("first.doc_id").alias("first_doc"), F.col("first.unit").alias("first_unit")))
    again = (rows.join(written(firsts, "substring-firsts"), "digest").where("doc_id <> first_doc or unit <> first_unit")
             .dropDuplicates(["doc_id", "unit"]))
    # Numbers that follow each other are as far apart as their ranks.
    island = F.col("unit") - F.row_number().over(Window.partitionBy("doc_id").orderBy("unit"))
    return (again.withColumn("island", island).groupBy("doc_id", "island").agg(
                F.min("start").cast("long").alias("start"), F.max("stop").cast("long").alias("stop"), F.sum("words").alias("n_words"),
                F.count("*").alias("n_units"), F.array_sort(F.collect_set("first_doc")).alias("first_docs"))
            .where(F.col("n_words") >= min_words).drop("island"))


def without_passages(docs: DataFrame, written, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with repeated passages cut from `text`, plus `removed`: their original spans."""
    gone = (passages(docs, written, unit, min_words).groupBy(F.col("doc_id").alias("_gone_id"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop")))).alias("_gone")))
    both = docs.join(gone, docs["doc_id"].cast("long") == gone["_gone_id"], "left")
    spans = F.coalesce("_gone", F.array().cast("array<struct<start:int,stop:int>>"))
    # What stays lies between the spans: before the first, between neighbours, after the last.
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["stop"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length("text")))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substr(F.col("text"), a + 1, b - a))
    text = F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    return both.select(*[(text if c == "text" else docs[c]).alias(c) for c in docs.columns], spans.alias("removed"))


PASSAGES_SQL = rf"""
WITH parts AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?\n]*[.!?]*\n?')) AS part,
         generate_subscripts(regexp_extract_all(text, '[^.!?\n]*[.!?]*\n?'), 1) AS i
  FROM documents WHERE doc_id IS NOT NULL),
placed AS (
  SELECT doc_id, i, length(rtrim(part, chr(10))) AS n,
         coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS body FROM parts),
units AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS unit, len(string_split(body, ' ')) AS words FROM placed WHERE body <> ''),
again AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, unit) AS k, first_value(doc_id) OVER (PARTITION BY body ORDER BY doc_id, unit) AS first_doc
  FROM units),
islands AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS island FROM again WHERE k > 1)
SELECT doc_id, min(start)::BIGINT AS start, max(start + n)::BIGINT AS stop, sum(words)::BIGINT AS n_words, count(*) AS n_units,
       list_sort(list(DISTINCT first_doc)) AS first_docs
FROM islands GROUP BY doc_id, island HAVING sum(words) >= {MIN_WORDS}
"""
