"""Scans over files rather than rows: listings, digests, footers, sortedness."""

from __future__ import annotations

import hashlib
import sys
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sampletide.sources.bounds import literal

# The task functions of this module travel to executors by value: the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOOTER_SCHEMA = ("file string, row_group int, group_rows long, column_name string, encodings string, "
                 "has_dictionary boolean, n_values long, packed_bytes long, raw_bytes long, min_value string, "
                 "created_by string")


def filesystem(path: str):
    """File system and inner path of a URI. Spark's names of object stores are mapped to those the reader knows."""
    for ours, theirs in (("s3a://", "s3://"), ("s3n://", "s3://"), ("gs://", "gs://"), ("wasbs://", "abfs://"), ("abfss://", "abfs://")):
        if path.startswith(ours):
            path = theirs + path[len(ours):]
    return pafs.FileSystem.from_uri(path)


def listing(spark: SparkSession, path, glob: str = "*") -> DataFrame:
    """path, length, modified of every file below `path`; column pruning keeps the content unread."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .load(path).select("path", "length", F.col("modificationTime").alias("modified")))


def _entries(batches):
    """What lies directly below each folder, in batches of bounded size."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner = filesystem(path)
            scheme = path.split("://", 1)[0]
            found = system.get_file_info(pafs.FileSelector(inner, recursive=False))
            for at in range(0, len(found), 10_000):
                part = found[at:at + 10_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{scheme}://{i.path}{'' if i.is_file else '/'}" for i in part], pa.string()),
                    pa.array([i.size if i.is_file else None for i in part], pa.int64())], names=["path", "length"])


def every_file(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """path and length of all files below a folder, empty ones included: Spark's own file scans leave those out.

    Level by level: the folders of a level are dealt to tasks anew, each level is written below `folder`.
    """
    root = (path if "://" in path else f"file://{path}").rstrip("/") + "/"
    schema, level, found = "path string, length long", literal(spark, [(root,)], "path string"), []
    while True:
        place = f"{folder}/level-{len(found)}"
        level.repartition("path").mapInArrow(_entries, schema).write.mode("overwrite").parquet(place)
        now = spark.read.schema(schema).parquet(place)
        found.append(now.where("length is not null"))
        level = now.where("length is null").select("path")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def aborted(spark: SparkSession, path: str, folder: str, suffix: str = ".parquet") -> DataFrame:
    """Empty files an aborted write left behind. `folder` takes the listing."""
    return every_file(spark, path, folder).where(F.col("path").endswith(suffix) & (F.col("length") == 0)).select("path")


def _hash_files(batches):
    for batch in batches:
        sums = []
        for path in batch.column(0).to_pylist():
            system, inner = filesystem(path)
            hasher = hashlib.sha256()
            with system.open_input_stream(inner) as source:
                while chunk := source.read(1 << 22):
                    hasher.update(chunk)
            sums.append(hasher.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sums, pa.string())],
                                         names=["path", "length", "sha256"])


def digests(spark: SparkSession, path, glob: str = "*.parquet") -> DataFrame:
    """sha256 of every file, read in chunks by the executors: a file of any size needs a few megabytes, where a
    binary column would hold it whole and stop at two gigabytes. The listing spreads files over tasks by size."""
    return hashed(listing(spark, path, glob).select("path", "length"))


def hashed(files: DataFrame) -> DataFrame:
    """path, length, sha256 of listed files (path, length)."""
    return files.mapInArrow(_hash_files, "path string, length long, sha256 string")


def _hash_runs(batches):
    """Digest of each run of equal `dataset` values, fed line by line: rows arrive sorted."""
    name = hasher = None
    for batch in batches:
        for dataset, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if dataset != name:
                if hasher is not None:
                    yield pa.RecordBatch.from_pydict({"dataset": [name], "dataset_version": [hasher.hexdigest()]})
                name, hasher = dataset, hashlib.sha256(digest.encode())
            else:
                hasher.update(b"\n" + digest.encode())
    if hasher is not None:
        yield pa.RecordBatch.from_pydict({"dataset": [name], "dataset_version": [hasher.hexdigest()]})


def dataset_versions(file_digests: DataFrame) -> DataFrame:
    """(dataset, sha256) per file to one digest per dataset over the sorted list of file digests.

    A digest over a list is sequential by definition, so each dataset's digests (64 bytes per file, not the
    files) are streamed through one hasher after a spillable sort; no list is held in memory.
    """
    ordered = (file_digests.select("dataset", "sha256").repartition("dataset")
               .sortWithinPartitions("dataset", "sha256"))
    return ordered.mapInArrow(_hash_runs, "dataset string, dataset_version string")


def _read_footers(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, inner = filesystem(path)
            with system.open_input_file(inner) as source:
                footer = pq.ParquetFile(source).metadata
            rows = []
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                for c in range(group.num_columns):
                    chunk = group.column(c)
                    stats = chunk.statistics
                    low = stats.min if stats is not None and stats.has_min_max else None
                    rows.append((path, g, group.num_rows, chunk.path_in_schema,
                                 ", ".join(sorted(set(chunk.encodings))), bool(chunk.has_dictionary_page),
                                 chunk.num_values, chunk.total_compressed_size, chunk.total_uncompressed_size,
                                 None if low is None else str(low), footer.created_by))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values), type=kind) for values, kind in zip(zip(*rows), _FOOTER_TYPES)]
                if rows else [pa.array([], type=kind) for kind in _FOOTER_TYPES],
                names=_FOOTER_NAMES)


_FOOTER_NAMES = [part.split()[0] for part in FOOTER_SCHEMA.split(", ")]
_FOOTER_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64(),
                 pa.int64(), pa.string(), pa.string()]


def footers(spark: SparkSession, path) -> DataFrame:
    """One row per row group and column chunk. Executors read the footers, a few kilobytes per file."""
    return listing(spark, path, "*.parquet").select("path").mapInArrow(_read_footers, FOOTER_SCHEMA)


def write_blobs(rows: DataFrame, root: str) -> None:
    """Files named by a row's `path` below `root`, holding its `content` (text). A task writes under a name of its own
    and renames, so a repeated task leaves one file."""
    target = root if "://" in root else f"file://{root}"

    def run(batches):
        import uuid
        for batch in batches:
            for below, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, base = filesystem(target)
                place = f"{base.rstrip('/')}/{below}"
                system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                trial = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
                with system.open_output_stream(trial) as out:
                    out.write(content.encode())
                system.move(trial, place)
            yield batch.select([0])
    rows.select("path", "content").mapInArrow(run, "path string").write.format("noop").mode("overwrite").save()


def _line_files(target: str):
    """Per task: (path, line) rows in order of path become files below `target`; one row is returned per file. The lines of a
    path in a batch are written at once."""
    def run(batches):
        import uuid
        system, base = filesystem(target)
        path = out = trial = place = None
        for batch in batches:
            paths, lines, closed = batch.column(0), batch.column(1), []
            cuts = np.flatnonzero(pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(paths)]):
                if lo == hi:
                    continue
                below = paths[lo].as_py()
                if below != path:
                    if out is not None:
                        out.close()
                        system.move(trial, place)
                        closed.append(path)
                    path, place = below, f"{base.rstrip('/')}/{below}"
                    folder = place.rsplit("/", 1)[0]
                    system.create_dir(folder, recursive=True)
                    trial = f"{folder}/.{uuid.uuid4().hex}"
                    out, first = system.open_output_stream(trial), True
                held = lines.slice(lo, hi - lo).drop_null().to_pylist()
                if held:
                    out.write((("" if first else "\n") + "\n".join(held)).encode())
                    first = False
            if closed:
                yield pa.RecordBatch.from_arrays([pa.array(closed, pa.string())], names=["path"])
        if out is not None:
            out.close()
            system.move(trial, place)
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string())], names=["path"])
    return run


def write_lines(rows: DataFrame, root: str) -> None:
    """Files named by `path` below `root` with the lines of that path in order; a path whose lines are null is an empty file.

    Lines are dealt by path, sorted and streamed, so a file of any size is never held; a task writes under a name of its
    own and renames, so a repeated task leaves one file.
    """
    target = root if "://" in root else f"file://{root}"
    dealt = rows.select("path", "line").repartition("path").sortWithinPartitions("path", "line")
    dealt.mapInArrow(_line_files(target), "path string").write.format("noop").mode("overwrite").save()


def copy(spark: SparkSession, source: str, target: str, glob: str = "*.parquet") -> DataFrame:
    """Copy files byte for byte on the executors; a retried task writes the same bytes again."""
    def run(batches):
        for batch in batches:
            for path, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reading, inner = filesystem(path)
                writing, base = filesystem(target_uri)
                place = f"{base.rstrip('/')}/{below}"
                writing.create_dir(place.rsplit("/", 1)[0], recursive=True)
                with reading.open_input_stream(inner) as r, writing.open_output_stream(place) as w:
                    while chunk := r.read(1 << 22):
                        w.write(chunk)
            yield batch

    target_uri = target if "://" in target else f"file://{target}"
    start = len(source.split("://", 1)[-1].rstrip("/")) + 2
    below = F.expr(f"substr(regexp_replace(path, '^file:/+', '/'), {start})")
    return listing(spark, source, glob).select("path", below.alias("below")).mapInArrow(run, "path string, below string")


def _stretches(order):
    """Per task: one row for each stretch of consecutive rows of a file, with the disorder inside it."""
    def before(left, right):
        """left sorts before right, column by column."""
        less, equal = pc.less(left[0], right[0]), pc.equal(left[0], right[0])
        for a, b in zip(left[1:], right[1:]):
            less = pc.or_(less, pc.and_(equal, pc.less(a, b)))
            equal = pc.and_(equal, pc.equal(a, b))
        return less

    def run(batches):
        open_ = None

        def close():
            values = [[open_["file"]], [open_["start"]], [open_["rows"]], [open_["disorder"]],
                      *[[v] for v in open_["first"]], *[[v] for v in open_["last"]]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            keys = [batch.column(2 + k) for k in range(len(order))]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[k.type for k in keys], *[k.type for k in keys]]
            names = ["file", "start", "rows", "disorder", *[f"first_{c}" for c in order], *[f"last_{c}" for c in order]]
            path, index = batch.column(0), batch.column(1).to_numpy()
            if not len(index):
                continue
            same = pc.equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False) & (np.diff(index) == 1)
            cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(index)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = [k.slice(lo, hi - lo) for k in keys]
                first, last = [p[0].as_py() for p in part], [p[-1].as_py() for p in part]
                wrong = pc.sum(before([p[1:] for p in part], [p[:-1] for p in part])).as_py() or 0
                name = path[lo].as_py()
                if open_ and open_["file"] == name and open_["start"] + open_["rows"] == index[lo]:
                    ends = None in first or None in open_["last"]
                    open_["disorder"] += wrong + (not ends and tuple(first) < tuple(open_["last"]))
                    open_["rows"] += hi - lo
                    open_["last"] = last
                else:
                    if open_:
                        yield close()
                    open_ = {"file": name, "start": int(index[lo]), "rows": hi - lo, "disorder": wrong, "first": first, "last": last}
        if open_:
            yield close()
    return run


def out_of_order(rows: DataFrame, order=("lid", "sample_idx")) -> DataFrame:
    """(file, rows, out_of_order): rows that sort before their predecessor in file order.

    A scan task reads its part of a file in order, so neighbours are compared where they are read and only one
    row per part is shuffled, to compare the parts' ends. Shuffling rows back into file order would move the
    whole table.
    """
    scanned = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"), *order)
    kinds = {f.name: f.dataType.simpleString() for f in scanned.schema}
    ends = ", ".join(f"{end}_{c} {kinds[c]}" for end in ("first", "last") for c in order)
    parts = scanned.mapInArrow(_stretches(tuple(order)), f"file string, start long, rows long, disorder long, {ends}")
    first, last = (F.struct(*[F.col(f"{end}_{c}").alias(c) for c in order]) for end in ("first", "last"))
    by_start = Window.partitionBy("file").orderBy("start")
    joined = parts.withColumns({"head": first, "before": F.lag(last).over(by_start)})
    return joined.groupBy("file").agg(
        F.sum("rows").alias("rows"), (F.sum("disorder") + F.count_if(F.col("head") < F.col("before"))).alias("out_of_order"))


def sizes(spark: SparkSession, root: str, layers=("bronze", "silver"), dataset: str = "recording") -> DataFrame:
    """Bytes of the sample files per layer and experiment."""
    paths = [f"{root}/{layer}/{dataset}" for layer in layers]
    part = F.regexp_extract
    return (listing(spark, paths, "*.parquet")
            .groupBy(part("path", rf"/([^/]+)/{dataset}/", 1).alias("layer"),
                     part("path", r"/experiment=([^/]+)/", 1).alias("experiment"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))
