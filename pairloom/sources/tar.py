"""Tar shards: members found by their headers, payloads read by offset.

A tar file is one stream, and one of them may hold much of the data. So a first pass reads
headers only and seeks over contents; its narrow table is grouped into samples and spread
over all tasks, which then read just their byte ranges. Payload bytes are never shuffled.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.runtime import ship_by_value

HEADERS = "path string, shard string, name string, key string, ext string, offset long, size long"
# Payload rows handed to Arrow at a time, bounding a task's memory.
READ_BYTES = 64 * 1024 * 1024
# Bytes of tar files that one task reads: what a lost one costs again.
TASK_BYTES = 256 * 1024 * 1024
FILE_URI = re.compile(r"^file:/+")


def _open(path: str):
    """Open any path Arrow knows a file system for; Spark lists local files as file:/x."""
    uri = FILE_URI.sub("file:///", path)
    system, inside = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inside)


def sample_name(member: tarfile.TarInfo) -> tuple[str, str] | None:
    """(key, extension) of a regular member; None if it holds no sample.

    A member ``dir/a.b.c`` belongs to key ``dir/a`` with extension ``b.c``, in lower case.
    Names whose last part starts with a dot, and ``__`` directories, hold no sample.
    """
    folder, _, base = member.name.rpartition("/")
    stem, dot, ext = base.partition(".")
    if not member.isfile() or not stem or not dot or base.startswith("__"):
        return None
    return (f"{folder}/{stem}" if folder else stem), ext.lower()


def list_tar_members(spark: SparkSession, glob: str) -> DataFrame:
    """One row per member that holds part of a sample: where it lies, its key and its extension."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                rows = []
                shard = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                with _open(path) as source, tarfile.open(fileobj=source, mode="r:") as tar:
                    for member in tar:
                        tar.members.clear()
                        named = sample_name(member)
                        if named is None:
                            continue
                        rows.append((path, shard, member.name, *named, member.offset_data, member.size))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                yield pd.DataFrame(rows, columns=columns)

    columns = [c.split()[0] for c in HEADERS.split(", ")]
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    n_files, size = files.agg(F.count("*"), F.sum("length")).first()
    spread = files.select("path").repartition(max(1, min(n_files, _tasks(spark, size))))
    return spread.mapInPandas(run, HEADERS)


def _tasks(spark: SparkSession, size: int | None) -> int:
    """Tasks for so many bytes: one for each ``TASK_BYTES``, and all cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-(size or 0) // TASK_BYTES))


def import_tar_shards(
    spark: SparkSession, glob: str, exts: tuple[str, ...] = ("jpg", "png", "json"), *,
    partitions: int | None = None,
) -> DataFrame:
    """(shard, key, one binary column per extension): members sharing a key form a sample.

    An extension that a sample lacks is NULL. Of two members with the same name the last one
    counts, as when a tar file is appended to.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[str, object] = {}
        for frame in frames:
            out, held = [], 0
            for row in frame.itertuples(index=False):
                record = [row.shard, row.key]
                if row.path not in opened:
                    for source in opened.values():
                        source.close()
                    opened = {row.path: _open(row.path)}
                for ext in range(len(exts)):
                    offset, size = getattr(row, f"offset_{ext}"), getattr(row, f"size_{ext}")
                    if pd.isna(offset):
                        record.append(None)
                        continue
                    opened[row.path].seek(int(offset))
                    record.append(opened[row.path].read(int(size)))
                    held += int(size)
                out.append(record)
                if held >= READ_BYTES:
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)
        for source in opened.values():
            source.close()

    names = ["shard", "key", *exts]
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    members = list_tar_members(spark, glob)
    where = [
        F.max(F.when(F.col("ext") == ext, F.struct("offset", "size"))).alias(f"at_{i}")
        for i, ext in enumerate(exts)
    ]
    found = members.where(F.col("ext").isin(*exts)).groupBy("path", "shard", "key").agg(*where)
    flat = found.select(
        "path", "shard", "key",
        *[F.col(f"at_{i}.{f}").alias(f"{f}_{i}") for i in range(len(exts)) for f in ("offset", "size")],
        F.least(*[F.col(f"at_{i}.offset") for i in range(len(exts))] + [F.lit(1 << 62)]).alias("_first"),
    )
    # Ranges of (path, offset): each task reads neighbouring bytes, and a huge file is split.
    n = partitions or _tasks(spark, files.agg(F.sum("length")).first()[0])
    located = flat.repartitionByRange(n, "path", "_first").sortWithinPartitions("path", "_first")
    schema = "shard string, key string, " + ", ".join(f"`{e}` binary" for e in exts)
    return located.drop("_first").mapInPandas(run, schema)


def decode_members(df: DataFrame, ext: str = "ext", data: str = "data") -> DataFrame:
    """Add ``kind`` and ``text``: ``.txt`` is UTF-8 text, ``.pth`` a tensor, the rest raw.

    Tensor bytes stay as they are. Unpickling them would run code from the data; tensors
    enter this library as arrays.
    """
    suffix = F.lower(F.col(ext))
    is_text = suffix.endswith("txt")
    return df.select(
        "*",
        F.when(is_text, "text").when(suffix.endswith("pth"), "tensor").otherwise("raw").alias("kind"),
        F.when(is_text, F.decode(data, "UTF-8")).alias("text"),
    )


ship_by_value(__name__)
