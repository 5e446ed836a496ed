"""A Spark data source for tar shards: partitions are byte ranges, filters on the shard choose files.

``spark.read.format("tar_members").load("/raw/{00000..00112}.tar")`` gives one row per member.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual,
)

from pairloom.runtime import ship_by_value
from pairloom.sources.tar import FILE_URI, READ_BYTES, sample_name

MEMBERS = "shard string, key string, ext string, name string, offset bigint, data binary"
RANGE_BYTES = 128 << 20
# Small ranges share tasks: more tasks than this only if one would read RANGE_BYTES or more.
TASKS = 512
BLOCK = tarfile.BLOCKSIZE
BRACES = re.compile(r"\{(\d+)\.\.(\d+)\}")
# Headers that say more about the member after them.
MORE = (tarfile.XHDTYPE, tarfile.XGLTYPE, tarfile.SOLARIS_XHDTYPE, tarfile.GNUTYPE_LONGNAME, tarfile.GNUTYPE_LONGLINK)
# How far before a header such headers are looked for, and how much is searched for a header at once.
BEFORE, WINDOW = 64 << 10, 8 << 20


def expand(path: str) -> list[str]:
    """Paths of a brace range such as ``{00000..00112}``, padded as its first bound is."""
    found = BRACES.search(path)
    if not found:
        return [path]
    low, high = int(found[1]), int(found[2])
    if low > high:
        raise ValueError(f"empty range {found[0]!r}")
    names = (str(i).zfill(len(found[1])) for i in range(low, high + 1))
    return [p for n in names for p in expand(path[: found.start()] + n + path[found.end() :])]


def shard_of(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0]


def _system(path: str) -> tuple[fs.FileSystem, str]:
    uri = FILE_URI.sub("file:///", path)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def header(block: bytes) -> tarfile.TarInfo | None:
    """The header in a block with a right checksum, else None."""
    try:
        return tarfile.TarInfo.frombuf(block, "utf-8", "surrogateescape")
    except tarfile.HeaderError:
        return None


def _after(at: int, info: tarfile.TarInfo) -> int:
    held = info.size if info.isreg() or info.type in MORE else 0
    return at + BLOCK + -(-held // BLOCK) * BLOCK


def _leads_on(source, at: int, end: int, size: int, known: set[int]) -> bool:
    """Do headers follow each other from ``at`` to ``end`` or to the end of the archive?

    ``known`` are headers of this file from which that was found before.
    """
    passed = []
    while at < end:
        if at in known:
            known.update(passed)
            return True
        passed.append(at)
        source.seek(at)
        block = source.read(BLOCK)
        if len(block) < BLOCK:
            return False
        if not any(block):
            # Only zeros follow the last member; those of an archive inside a member have more after them.
            source.seek(at)
            while rest := source.read(WINDOW):
                if any(rest):
                    return False
            known.update(passed)
            return True
        info = header(block)
        if info is None:
            return False
        at = _after(at, info)
    if at > size:
        return False
    known.update(passed)
    return True


def first_header(
    source, start: int, end: int, size: int, plain: bool = False, known: set[int] | None = None
) -> int | None:
    """Where the first member that begins in [start, end) has its first header.

    A block with a right checksum counts if headers follow from it up to the end of the archive. If
    one does not, as in an archive stored inside a member, headers are followed from the
    beginning of the file instead. Of ``plain`` files, whose members hold no archives, headers are
    followed to the end of the range only. Ranges of one file may share ``known``, the headers that
    were followed, so that none is followed twice.
    """
    known = set() if known is None or plain else known
    if start == 0:
        return 0 if size else None
    for base in range(start, end, WINDOW):
        source.seek(base)
        data = source.read(min(WINDOW, end - base))
        blocks = np.frombuffer(data[: len(data) // BLOCK * BLOCK], np.uint8).reshape(-1, BLOCK)
        magic = (blocks[:, 257:262] == np.frombuffer(b"ustar", np.uint8)).all(axis=1)
        for i in np.flatnonzero(magic).tolist():
            at = base + i * BLOCK
            info = header(blocks[i].tobytes())
            if info is None:
                continue
            if not _leads_on(source, at, end if plain else size, size, known):
                return _walk(source, start, end)
            # A header that belongs to one before it is read with that one, by the range before.
            low = max(0, at - BEFORE)
            source.seek(low)
            before = source.read(at - low)
            for j in range(len(before) - BLOCK, -1, -BLOCK):
                if before[j + 156 : j + 157] not in MORE:  # its type, as most blocks are no headers
                    continue
                prior = header(before[j : j + BLOCK])
                if prior and prior.type in MORE and _after(low + j, prior) == at:
                    if low + j < start:
                        return _begins(source, _after(at, info), end)
                    return low + j
            return at
    return _walk(source, start, end) if not _ustar(source) else None


def _ustar(source) -> bool:
    source.seek(0)
    return source.read(BLOCK)[257:262] == b"ustar"


def _begins(source, at: int, end: int) -> int | None:
    source.seek(at)
    return at if at < end and any(source.read(BLOCK)) else None


def _walk(source, start: int, end: int) -> int | None:
    """The same, following headers from the beginning of the file."""
    at, first = 0, None
    while at < end:
        source.seek(at)
        block = source.read(BLOCK)
        info = header(block) if len(block) == BLOCK and any(block) else None
        if info is None:
            return None
        first = at if first is None else first
        if info.type not in MORE:
            if first >= start:
                return first
            first = None
        at = _after(at, info)
    return first if first is not None and first >= start else None


def read_range(path: str, start: int, end: int, plain: bool = False) -> Iterator[tuple]:
    """(shard, key, ext, name, offset, data) of members whose first header lies in [start, end)."""
    return read_ranges(path, start, end, end - start, plain)


def read_ranges(path: str, start: int, end: int, size: int, plain: bool = False) -> Iterator[tuple]:
    """The same for neighbouring ranges of ``size`` bytes from ``start`` to ``end``, with the file opened once."""
    system, inside = _system(path)
    with system.open_input_file(inside) as source:
        known: set[int] = set()
        for low in range(start, end, size):
            yield from _members(source, path, low, min(end, low + size), plain, known)


def _members(source, path: str, start: int, end: int, plain: bool, known: set[int]) -> Iterator[tuple]:
    at = first_header(source, start, end, source.size(), plain, known)
    while at is not None and at < end:
        source.seek(at)
        with tarfile.open(fileobj=_From(source, at), mode="r:") as tar:
            try:
                member = tar.next()
            except tarfile.ReadError as error:
                raise ValueError(f"{path} is damaged at byte {at}") from error
        if member is None:
            return
        named = sample_name(member)
        if named:
            source.seek(at + member.offset_data)
            yield shard_of(path), *named, member.name, at + member.offset_data, source.read(member.size)
        at += member.offset_data + -(-(member.size if member.isreg() else 0) // BLOCK) * BLOCK


class _From:
    """A file as it looks from a place in it."""

    def __init__(self, source, base: int) -> None:
        self.source, self.base = source, base

    def read(self, n: int = -1) -> bytes:
        return self.source.read(n)

    def seek(self, at: int, whence: int = 0) -> int:
        return self.source.seek(self.base + at) - self.base

    def tell(self) -> int:
        return self.source.tell() - self.base


@dataclass
class Range:
    path: str
    start: int
    end: int


@dataclass
class Ranges(InputPartition):
    parts: tuple[Range, ...]


class Reader(DataSourceReader):
    def __init__(self, paths: list[str], size: int, plain: bool = False) -> None:
        self.paths, self.size, self.plain = paths, size, plain
        self.tests: list[tuple[type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        known = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for one in filters:
            if isinstance(one, known) and one.attribute == ("shard",):
                self.tests.append((type(one), one.value))
            else:
                yield one

    def wanted(self, shard: str) -> bool:
        holds = {
            EqualTo: lambda v: shard == v, In: lambda v: shard in v, GreaterThan: lambda v: shard > v,
            GreaterThanOrEqual: lambda v: shard >= v, LessThan: lambda v: shard < v, LessThanOrEqual: lambda v: shard <= v,
        }
        return all(holds[kind](value) for kind, value in self.tests)

    def files(self) -> Iterator[fs.FileInfo]:
        for pattern in self.paths:
            for path in expand(pattern):
                system, inside = _system(path)
                folder, _, name = inside.rpartition("/")
                if any(c in name for c in "*?["):
                    listed = system.get_file_info(fs.FileSelector(folder))
                    infos = [i for i in listed if i.type == fs.FileType.File and fnmatch(i.base_name, name)]
                elif not self.wanted(shard_of(name)):
                    continue
                else:
                    infos = [system.get_file_info(inside)]
                    if infos[0].type != fs.FileType.File:
                        raise FileNotFoundError(path)
                head = path[: len(path) - len(name)]
                yield from (
                    Range(f"{head}{i.base_name}", 0, i.size)
                    for i in sorted(infos, key=lambda i: i.base_name) if self.wanted(shard_of(i.base_name))
                )

    def partitions(self) -> Sequence[InputPartition]:
        """Neighbouring ranges, of one file or of several, share a task while it reads little."""
        files = list(self.files())
        task = max(self.size, min(RANGE_BYTES, sum(f.end for f in files) // TASKS))
        per = task // self.size
        parts, room = [], 0
        for f in files:
            at = 0
            while at < f.end:
                if not room:
                    parts.append([])
                    room = per
                # A file of one range or less counts as one, as opening it costs as much.
                n = min(room, -(-(f.end - at) // self.size))
                parts[-1].append(Range(f.path, at, min(f.end, at + n * self.size)))
                at += n * self.size
                room -= n
        return [Ranges(tuple(p)) for p in parts]

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return  # no file is wanted
        rows, held = [], 0
        for part in partition.parts:
            for row in read_ranges(part.path, part.start, part.end, self.size, self.plain):
                rows.append(row)
                held += len(row[-1])
                if held >= READ_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    string = pa.string()
    kinds = [string, string, string, string, pa.int64(), pa.binary()]
    names = [c.split()[0] for c in MEMBERS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class TarMembers(DataSource):
    """Options: ``path``, or ``paths`` separated by commas, ``rangeBytes`` and ``plain``."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> Reader:
        size = int(self.options.get("rangeBytes", RANGE_BYTES))
        if size < BLOCK or size % BLOCK:
            raise ValueError(f"rangeBytes must be a multiple of {BLOCK}")
        paths = [p for p in (self.options.get("paths") or self.options["path"]).split(",") if p]
        return Reader(paths, size, self.options.get("plain", "false").lower() == "true")


def read_tar_members(
    spark: SparkSession, path: str, *, range_bytes: int = RANGE_BYTES, plain: bool = False
) -> DataFrame:
    """(shard, key, ext, name, offset, data) of the members of tar shards.

    ``path`` may hold a brace range or a pattern in its last part. Every range of ``range_bytes`` of
    a file is read by itself. Where there are many small ones, neighbours share a task and what
    they learn of their file; the tasks grow with the bytes, and a lost one costs its ranges.
    Files whose shard a filter rules out are not opened. The driver lists names and sizes only.
    A range finds its first header by itself; say ``plain`` if no member is an uncompressed
    archive, and it need not follow the headers behind it to be sure.
    """
    spark.dataSource.register(TarMembers)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("tar_members").option("rangeBytes", range_bytes).option("plain", plain).load(path)


def tar_samples(members: DataFrame, exts: tuple[str, ...] = ("jpg", "png", "json")) -> DataFrame:
    """(shard, key, one column per extension); of two members with one name the last counts."""
    wanted = members.where(F.col("ext").isin(*exts))
    picked = [F.max_by("data", F.when(F.col("ext") == e, F.col("offset"))).alias(e) for e in exts]
    return wanted.groupBy("shard", "key").agg(*picked)


ship_by_value(__name__)
