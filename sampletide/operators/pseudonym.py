"""Source codes to pseudonyms and, logged, back."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HMAC-SHA256: block size in bytes, and the bytes its two pads are made of.
BLOCK, INNER, OUTER = 64, 0x36, 0x5C


def pseudonymise(rows: DataFrame, secret: bytes, code: str = "subject_src") -> DataFrame:
    """`rows` with subject_pid: the first 16 digits of the code's HMAC-SHA256; NULL for NULL.

    The two pads of the secret are the row of a table that the digest reads as scalar subqueries. They are no literals of the
    plan, so explained plans, event logs and error texts do not hold them, and nothing is written to disk.
    """
    key = (hashlib.sha256(secret).digest() if len(secret) > BLOCK else secret).ljust(BLOCK, b"\0")
    pads = rows.sparkSession.createDataFrame([tuple(bytearray(k ^ pad for k in key) for pad in (INNER, OUTER))], "inner_pad binary, outer_pad binary")
    inner = F.sha2(F.concat(pads.select("inner_pad").scalar(), F.encode(code, "UTF-8")), 256)
    outer = F.sha2(F.concat(pads.select("outer_pad").scalar(), F.unhex(inner)), 256)
    return rows.withColumn("subject_pid", F.substring(outer, 1, 16))


def new_keys(codes: DataFrame, key_map: DataFrame, secret: bytes) -> DataFrame:
    """Key-map rows of codes not seen before. Known codes keep the row they have."""
    seen = codes.groupBy("subject_src").agg(F.min("created_at").alias("created_at"))
    fresh = seen.join(key_map.select("subject_src"), "subject_src", "left_anti")
    return pseudonymise(fresh, secret).select("subject_src", "subject_pid", "created_at")


def replace_code(rows: DataFrame, key_map: DataFrame) -> DataFrame:
    """`subject_pid` in place of `subject_src`. Every mapped code came from an ingested file."""
    keys = key_map.select("subject_src", "subject_pid")
    return rows.join(keys, "subject_src").drop("subject_src")


def reidentify(requests: DataFrame, key_map: DataFrame, log_path: str) -> DataFrame:
    """Codes of requested pseudonyms, NULL for unknown ones. Every request is logged before it is answered."""
    logged = [c for c in ("request_id", "accessed_at", "actor", "purpose", "subject_pid") if c in requests.columns]
    requests.select(*logged).write.mode("append").parquet(log_path)
    keys = key_map.select("subject_pid", "subject_src")
    return requests.join(keys, "subject_pid", "left")
