"""Stored objects, one file each: gzip pages, JSON sidecars and the like, read and written by Spark as the source ``stored_objects``.

Reading lists the folder with sizes and packs neighbouring objects into partitions of about ``partition_bytes`` (an object counts
``open_bytes`` more than its size), so a million small files are not a million tasks. Up to ``LISTED`` objects are named one by one. Of more
the driver keeps no names: it adds up costs over ``SLOTS`` hash slots of a folder at a time, and a task gets runs of slots, lists their folders again and takes
what falls into them. A folder is listed some ``PASSES`` times at most, more often only if it is small. A task streams each object through gunzip and sha256 a
piece at a time: unless its text is asked for, an object of any size takes one buffer of memory. A condition on the beginning of
``key`` (``=``, ``startswith``) chooses the folder to list and the objects to open.

Writing puts each row's ``body`` under its ``key``, compressed where the key ends in ``.gz``. A task writes beside the object and renames, and equal
bodies give equal bytes, so tasks that run twice or die half-way leave whole objects only.

Paths may be local or of any store that pyarrow opens (s3, gs, hdfs). What only Spark's own readers open is read by ``hadoop_objects``,
with the same columns.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, InputPartition, StringStartsWith, WriterCommitMessage

PIECE = 1 << 20
#: Rows and characters of text that a task gathers before it hands them on.
ROWS, TEXT = 1000, 8 << 20
#: Objects that the driver names; hash slots of a larger folder, and how often tasks list it: up to PASSES times, or until ENTRIES were seen.
LISTED, SLOTS, PASSES, ENTRIES = 100_000, 4096, 32, 1 << 22
SCHEMA = "key string, modified_at timestamp, stored_bytes bigint, size_bytes bigint, content_hash string, readable boolean, text string"


def open_store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def entries(store, folder: str) -> Iterator[tuple[str, str, bool, bool, Callable[[], tuple[int, int | None]]]]:
    """(path, name, is a folder, is a file, a function for bytes and microseconds since 1970) of what lies in a folder; of a local one without holding the list."""
    from pyarrow import fs

    if not isinstance(store, fs.LocalFileSystem):
        for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            facts = info.size or 0, info.mtime_ns // 1000 if info.mtime_ns is not None else None
            yield info.path, info.base_name, info.type == fs.FileType.Directory, info.is_file, lambda facts=facts: facts
        return
    try:
        found = os.scandir(folder)
    except FileNotFoundError:
        return
    with found:
        for entry in found:
            yield entry.path, entry.name, entry.is_dir(), entry.is_file(), lambda entry=entry: ((s := entry.stat()).st_size, s.st_mtime_ns // 1000)


class Content:
    """Size, sha256 and, if asked for, text of an object that comes in pieces; ``readable`` is false if it is damaged."""

    def __init__(self, packed: bool, keep: bool) -> None:
        self.packed, self.keep, self.size, self.readable = packed, keep, 0, True
        self.hash, self.parts, self.inflate = hashlib.sha256(), [], zlib.decompressobj(31)
        self.ended = not packed

    def add(self, data: bytes) -> None:
        if not self.packed:
            return self._plain(data)
        more = True
        while (data or more) and self.readable:
            if data and self.inflate.eof:  # a file may have several members
                self.inflate = zlib.decompressobj(31)
            try:
                out = self.inflate.decompress(data, PIECE)
            except zlib.error:
                self.readable = False
                return None
            self._plain(out)
            data, more = self.inflate.unconsumed_tail or self.inflate.unused_data, len(out) == PIECE
        return None

    def _plain(self, data: bytes) -> None:
        self.size += len(data)
        self.hash.update(data)
        if self.keep:
            self.parts.append(data)

    def end(self) -> tuple[int | None, str | None, bool, str | None]:
        """(size, hash, readable, text)"""
        if self.packed and not self.inflate.eof:
            self.readable = False
        if not self.readable:
            return None, None, False, None
        return self.size, self.hash.hexdigest(), True, b"".join(self.parts).decode("utf-8", "replace") if self.keep else None


@dataclass
class Objects(InputPartition):
    files: list[tuple[str, str, int, int | None]]  # path, key, stored bytes, microseconds since 1970
    runs: list[tuple[str, int, int]] = field(default_factory=list)  # folder, first slot and the one after the last: listed by the task


class ObjectReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.suffix, self.folder, self.prefix = options.get("suffix", ""), options.get("folder", "").strip("/"), ""
        self.keep = options.get("text", "false").lower() == "true"
        self.limit, self.cost = int(options.get("partition_bytes", 64 << 20)), int(options.get("open_bytes", 256 << 10))
        self.exact: str | None = None

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (StringStartsWith, EqualTo)) and f.attribute == ("key",) and isinstance(f.value, str):
                if len(f.value) > len(self.prefix):
                    self.prefix = f.value
                if isinstance(f, EqualTo):
                    self.exact = f.value
            yield f  # Spark applies it again

    def _folders(self) -> Iterator[str]:
        """Folders below the root that can hold wanted keys, as keys; a folder before those in it."""
        # of a prefix the whole folders are known
        deepest = self.prefix.rpartition("/")[0]
        if self.folder and not f"{deepest}/".startswith(f"{self.folder}/"):
            deepest = self.folder
        store, base = open_store(self.root)
        waiting = [deepest]
        while waiting:
            folder = waiting.pop()
            yield folder
            within = (f"{folder}/{e[1]}".lstrip("/") for e in entries(store, f"{base.rstrip('/')}/{folder}".rstrip("/") or "/") if e[2])
            waiting.extend(key for key in within if not _hidden(key) and f"{key}/".startswith(self.prefix[: len(key) + 1]))

    def _files(self, folder: str, first: int = 0, end: int = SLOTS) -> Iterator[tuple[str, str, int, int | None]]:
        """Wanted objects of a folder, without those of folders in it; only those of some slots are looked at."""
        store, base = open_store(self.root)
        inside = not self.folder or f"{folder}/".startswith(f"{self.folder}/")
        for path, name, _, is_file, facts in entries(store, f"{base.rstrip('/')}/{folder}".rstrip("/") or "/"):
            key = f"{folder}/{name}".lstrip("/")
            if is_file and inside and key.endswith(self.suffix) and key.startswith(self.prefix) and self.exact in (None, key) and not _hidden(key):
                if end - first < SLOTS and not first <= _slot(key) < end:
                    continue
                try:
                    yield path, key, *facts()
                except FileNotFoundError:  # went since
                    continue

    def partitions(self) -> list[Objects]:
        listed = list(islice(chain.from_iterable(map(self._files, self._folders())), LISTED + 1))
        if len(listed) > LISTED:
            del listed
            return self._cut()
        packed: list[Objects] = []
        size = self.limit
        for file in sorted(listed):
            cost = file[2] + self.cost
            if size + cost > self.limit and size:
                packed.append(Objects([]))
                size = 0
            packed[-1].files.append(file)
            size += cost
        return packed or [Objects([])]

    def _cut(self) -> list[Objects]:
        """Partitions of slots, not of named objects; small neighbouring folders share one."""
        packed: list[Objects] = []
        size = 0
        for folder in self._folders():
            costs, n = [0] * SLOTS, 0
            for _, key, stored, _ in self._files(folder):
                costs[_slot(key)] += stored + self.cost
                n += 1
            limit = max(self.limit, sum(costs) // max(PASSES, ENTRIES // max(n, 1)))
            first = None
            for slot, cost in enumerate(costs):
                if cost and (not packed or size and size + cost > limit):
                    if first is not None:
                        packed[-1].runs.append((folder, first, slot))
                    packed.append(Objects([]))
                    first, size = None, 0
                if cost:
                    first, size = slot if first is None else first, size + cost
            if first is not None:
                packed[-1].runs.append((folder, first, SLOTS))
        return packed or [Objects([])]

    def read(self, partition: Objects) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.root)
        rows: list[tuple] = []
        size = 0
        for path, key, stored, modified in chain(partition.files, *(self._files(*run) for run in partition.runs)):
            content = Content(key.endswith(".gz"), self.keep)
            try:
                with store.open_input_stream(path, compression=None) as stream:
                    while data := stream.read(PIECE):
                        content.add(data)
            except FileNotFoundError:  # went after it was listed
                continue
            n, digest, readable, text = content.end()
            rows.append((key, modified, stored, n, digest, readable, text))
            size += len(text or "")
            if len(rows) >= ROWS or size >= TEXT:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def _slot(key: str) -> int:
    return zlib.crc32(key.encode("utf-8", "surrogateescape")) % SLOTS


def _hidden(key: str) -> bool:
    return any(part.startswith((".", "_")) for part in key.split("/"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    columns = zip(*rows, strict=True)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


class ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")

    def write(self, iterator) -> WriterCommitMessage:
        store, base = open_store(self.root)
        folders: set[str] = set()
        for row in iterator:
            body = row["body"]
            data = body.encode() if isinstance(body, str) else bytes(body or b"")
            path = f"{base.rstrip('/')}/{row['key']}"
            folder, _, name = path.rpartition("/")
            if folder not in folders:
                store.create_dir(folder, recursive=True)
                folders.add(folder)
            beside = f"{folder}/.{name}.{uuid.uuid4().hex}"
            try:
                with store.open_output_stream(beside, compression=None) as out:
                    out.write(gzip.compress(data, 6, mtime=0) if name.endswith(".gz") else data)
                store.move(beside, path)
            except BaseException:
                if store.get_file_info(beside).is_file:
                    store.delete_file(beside)
                raise
        return WriterCommitMessage()


class StoredObjects(DataSource):
    """Options: ``path``; for reading ``folder`` below it, ``suffix`` of keys, ``text`` (true to have it), ``partition_bytes``, ``open_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "stored_objects"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ObjectReader:
        return ObjectReader(dict(self.options))

    def writer(self, schema, overwrite) -> ObjectWriter:
        return ObjectWriter(dict(self.options))


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(StoredObjects)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def hadoop_objects(spark: SparkSession, root: str, folder: str = "", suffix: str = "", text: bool = False) -> DataFrame:
    """The same rows by Spark's own file source, which packs by size as well, holds a stored object whole, and passes over files of no bytes."""
    base = f"{root.rstrip('/')}/{folder}".rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(base)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    key = F.concat(F.lit(f"{folder}/" if folder else ""), F.substring_index(path, f"/{base.rstrip('/').rpartition('/')[2]}/", -1))
    rows = files.select(key.alias("key"), F.col("modificationTime").alias("modified_at"), F.col("length").alias("stored_bytes"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                k, modified, stored, body = (batch.column(c)[i].as_py() for c in ("key", "modified_at", "stored_bytes", "content"))
                content = Content(k.endswith(".gz"), text)
                content.add(body)
                yield _batch([(k, modified, stored, *content.end())])

    return rows.mapInArrow(run, SCHEMA)


def read_objects(spark: SparkSession, root: str, folder: str = "", suffix: str = "", text: bool = False, **options: str) -> DataFrame:
    """key (path below ``root``), modified_at, stored_bytes, size_bytes and content_hash (sha256) of what an object holds, readable, and text if asked for.

    A damaged object has a row that is not readable, with null size and hash. Names that begin with a dot or underscore are not listed.
    """
    if "://" in root and root.split("://")[0] not in ("file", "s3", "gs", "gcs", "hdfs"):
        return hadoop_objects(spark, root, folder, suffix, text)
    _registered(spark)
    reader = spark.read.format("stored_objects").option("folder", folder).option("suffix", suffix).option("text", str(text).lower())
    return reader.options(**options).load(root)


def write_objects(rows: DataFrame, root: str) -> None:
    """Write each row's ``body`` (text or bytes; null: empty) to ``root``/``key``. Of rows with equal keys one stays."""
    _registered(rows.sparkSession)
    rows.select("key", "body").write.format("stored_objects").mode("append").save(root)
