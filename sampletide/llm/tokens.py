"""Token ids in Arrow stream-files of equal-length sequences.

A file is Arrow's stream with a footer. Every record batch holds `ids` and `mask` as fixed-size lists, so sequence i of
a batch is a slice of one buffer: a memory map gives it without copying or decoding. Ids take 16 bits where the
vocabulary allows, the mask one (false: padding). `docs` and `ends` list the documents that end in a sequence and the
places of their last ids, which makes a file complete in itself. Documents are range-partitioned by id: a file holds consecutive documents, only its last row is padded.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sampletide.llm.common import travels

travels(__name__)

LENGTH, BATCH_ROWS, END = 2048, 256, 1
# Ids that one file should hold at most, by the measure of one id per four characters.
CHARS_PER_FILE = 64_000_000
MARKS = (b".", b",", b";", b":", b"!", b"?")
# Letters below this one are written the same in all Unicode versions and normal forms.
PLAIN = "\u0250"
LAST = int(END).to_bytes(4, "little")
CACHE = 800_000


def schema_of(length: int, vocabulary: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint16() if vocabulary <= 1 << 16 else pa.uint32(), length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("docs", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a path or URI; Spark's names for S3 are mapped to Arrow's."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path) if "://" in path or path.startswith("file:") else f"file://{path}")


class Encoder:
    """Ids of whole texts, with the end id. Pieces between spaces and line breaks encode independently of each other,
    and ASCII case does not count, so each distinct piece is encoded once and remembered; the memory is bounded and
    starts anew when full. A plain word needs no normalising or splitting, only the vocabulary's merges; a mark after a
    word is a piece of its own. Texts that may hold special tokens are encoded as they are."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.merges = self.tokenizer.model.tokenize
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def piece(self, piece: bytes) -> bytes:
        word, mark = (piece[:-1], piece[-1:]) if piece[-1:] in MARKS and piece else (piece, b"")
        text = word.decode()
        if text.isalpha() and max(text) < PLAIN and text == text.lower():
            ids = [t.id for t in self.merges(text if text.isascii() else self.bytes(text)[0][0])]
            return array("I", ids).tobytes() + (self.known.get(mark) or array("I", self.ids(mark.decode())).tobytes() if mark else b"")
        return array("I", self.ids(piece.decode())).tobytes()

    def __call__(self, text: str) -> np.ndarray:
        if "<|" in text:
            return np.array([*self.ids(text), END], "<u4")
        pieces = text.encode().lower().replace(b"\n", b" ").split(b" ")
        known = self.known
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, pieces)) + LAST, "<u4")
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for p in set(pieces):
                if p not in known:
                    known[p] = self.piece(p)
        return np.frombuffer(b"".join(map(known.__getitem__, pieces)) + LAST, "<u4")


def encoder(path: str) -> Encoder:
    """One per Python worker: what it remembers serves the tasks to come. Modules outlive a task, task functions do not."""
    import sys
    import types
    kept = sys.modules.setdefault("_encoders_of_this_worker", types.ModuleType("_encoders_of_this_worker"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


class Rows:
    """Collects documents' ids and writes them as full batches of equal-length rows."""

    def __init__(self, sink, length: int, vocabulary: int):
        self.length, self.schema = length, schema_of(length, vocabulary)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.ends, self.docs, self.held, self.total = [], [], [], 0, 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        self.ends.append(self.held - 1)
        self.docs.append(doc_id)
        if self.held >= self.length * BATCH_ROWS:
            self.write(self.held // self.length)

    def write(self, rows: int) -> None:
        flat = np.concatenate(self.ids) if self.ids else np.zeros(0, np.uint32)
        size = rows * self.length
        wide = self.schema.field("ids").type.value_type
        ids, used = np.zeros(size, wide.to_pandas_dtype()), min(size, len(flat))
        ids[:used] = flat[:used]
        ends = np.array(self.ends, np.int64)
        done = ends < used
        docs, row_of = [d for d, x in zip(self.docs, done, strict=True) if x], ends[done] // self.length
        cuts = pa.array(np.searchsorted(row_of, np.arange(rows + 1)), pa.int32())
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(pa.array(np.arange(size) < used), self.length),
             pa.ListArray.from_arrays(cuts, pa.array(docs, pa.int64())), pa.ListArray.from_arrays(cuts, pa.array(ends[done] % self.length, pa.int32()))], schema=self.schema))
        self.ids, self.held = [flat[used:]] if used < len(flat) else [], len(flat) - used
        self.docs = [d for d, x in zip(self.docs, done, strict=True) if not x]
        self.ends = (ends[~done] - used).tolist()

    def close(self) -> None:
        if self.held:
            self.write(-(-self.held // self.length))
        self.writer.close()


def write(docs: DataFrame, out: str, tokenizer: str, written, length: int = LENGTH, files: int | None = None) -> DataFrame:
    """Write `docs` (doc_id, text) below `out` in ascending id order; returns the manifest (file, n_docs, n_ids, start).

    Null texts are empty: they hold the end id alone. Rows that repeat an id stay apart, null ids come first. An empty
    table writes nothing and gives an empty manifest. Other columns are not read. Without `files`, their number
    follows the characters. A task writes to a name of its own and renames at the end, so a repeated task leaves one file.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if files is None:
        chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
        files = max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_PER_FILE))
    ordered = own.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        rows = sink = None
        n = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
                if rows is None:
                    encode = encoder(tokenizer)
                    system, folder = opened(out)
                    system.create_dir(folder, recursive=True)
                    trial = f"{folder}/_{uuid.uuid4().hex}"
                    sink = system.open_output_stream(trial)
                    rows = Rows(sink, length, encode.tokenizer.get_vocab_size())
                rows.add(doc_id, encode(text))
                n += 1
        if rows is not None:
            rows.close()
            sink.close()
            from pyspark import TaskContext
            name = f"ids-{TaskContext.get().partitionId():06d}.arrow"
            if system.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
                system.delete_file(f"{folder}/{name}")
            system.move(trial, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [f"{out}/{name}"], "place": [name], "n_docs": [n], "n_ids": [rows.total]})
    made = written(ordered.mapInArrow(run, "file string, place string, n_docs long, n_ids long"), "token-files")
    # One row per file: files are numbered in id order.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return made.withColumn("start", before.cast("long")).select("file", "n_docs", "n_ids", "start")


def _texts(column):
    for i in range(0, len(column), 64):
        yield from column.slice(i, 64).to_pylist()


def sequences(path: str, batch: int) -> pa.RecordBatch:
    """One batch of a local file through a memory map: its lists are views of the file."""
    return pa.ipc.open_file(pa.memory_map(path)).get_batch(batch)


def documents(path: str):
    """(doc_id, ids) of every document of a file, from its batches in turn."""
    system, inner = opened(path)
    with system.open_input_file(inner) as source:
        reader = pa.ipc.open_file(source)
        held = []
        for i in range(reader.num_record_batches):
            batch = reader.get_batch(i)
            ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
            length, ends = batch.schema.field(0).type.list_size, batch.column(3)
            row_of = np.repeat(np.arange(batch.num_rows), ends.value_lengths().to_numpy())
            at = 0
            for doc_id, end in zip(batch.column(2).flatten().to_pylist(), row_of * length + ends.flatten().to_numpy() + 1, strict=True):
                yield doc_id, np.concatenate([*held, ids[at:end]]) if held else ids[at:end]
                held, at = [], end
            if at < len(ids):
                rest = ids[at:at + int(batch.column(1).flatten().slice(at).true_count)]
                if len(rest):
                    held.append(rest.copy())


def read(manifest: DataFrame, written=None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files of a manifest."""
    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, ids in documents(path):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)
    files = manifest.select("file", "start")
    # One file a task where the cluster has room.
    return files.repartition(max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32"])


