"""Files of any size, read and written as streams inside tasks.

``binaryFile`` puts a file into one row and so ends at 2 GB. Transfers are
handled by path instead: a task opens the file itself and works through it in
chunks. One file is one task's work, as an archive cannot be split.
"""

from __future__ import annotations

import gzip
import hashlib
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from .files import MEMBER_COLUMNS, batched_rows, member_rows, member_schema

_CHUNK = 8 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system on which Spark would find it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a qualified location."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        raise ValueError(f"location '{path}' names no file system")
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


class _Counted:
    """A stream that knows the size and checksum of what passed through it."""

    def __init__(self, stream):
        self._stream, self._digest, self.size = stream, hashlib.sha256(), 0

    def _seen(self, data: bytes) -> bytes:
        self._digest.update(data)
        self.size += len(data)
        return data

    def read(self, n: int = -1) -> bytes:
        return self._seen(self._stream.read(n if n and n > 0 else None))

    def write(self, data: bytes) -> int:
        self._stream.write(self._seen(bytes(data)))
        return len(data)

    def flush(self) -> None:
        pass

    @property
    def sha256(self) -> str:
        return self._digest.hexdigest()


def _output(path: str):
    store, inner = open_store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


def _input(path: str):
    store, inner = open_store(path)
    return store.open_input_stream(inner, compression=None)


def _schema(df: DataFrame, keys: list[str], more: str) -> str:
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    return f"{kept}, {more}"


def hash_files(files: DataFrame, keys: list[str], path: str = "key") -> DataFrame:
    """SHA-256 of files given by path."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = []
            for name in batch["__path"]:
                with _input(name) as stream:
                    counted = _Counted(stream)
                    while counted.read(_CHUNK):
                        pass
                digests.append(counted.sha256)
            yield batch[keys].assign(sha256=digests)

    return files.select(*keys, files[path].alias("__path")).mapInPandas(work, _schema(files, keys, "sha256 string"))


def unpack_archives(archives: DataFrame, keys: list[str], path: str = "key") -> DataFrame:
    """Regular files of each tar.gz given by path, as rows of ``member_rows``."""
    def found(name: str) -> Iterator[tuple]:
        with _input(name) as stream:
            yield from member_rows(stream)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for batch in batches:
            for *key, name in batch[[*keys, "__path"]].itertuples(index=False, name=None):
                for row in found(name):
                    yield *key, *row

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from batched_rows(rows(batches), [*keys, *MEMBER_COLUMNS])
    return archives.select(*keys, archives[path].alias("__path")).mapInPandas(work, member_schema(archives, keys))


def pack_files(files: DataFrame, keys: list[str], name: str, target: str, path: str = "key") -> DataFrame:
    """A tar.gz per file, written to the location in ``target``; sizes and checksums of both as rows."""
    def pack(source: str, member: str, size: int, place: str) -> tuple:
        with _input(source) as stream, _output(place) as out:
            packed, counted = _Counted(out), _Counted(stream)
            with gzip.GzipFile(fileobj=packed, mode="wb", compresslevel=6, mtime=0) as body, tarfile.open(
                    fileobj=body, mode="w|") as tar:
                info = tarfile.TarInfo(member)
                info.size = size
                tar.addfile(info, counted)
        return counted.size, counted.sha256, packed.size, packed.sha256

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = zip(batch["__path"], batch["__name"], batch["__size"], batch["__target"])
            done = [pack(source, member, int(size), place) for source, member, size, place in columns]
            measured = pd.DataFrame(
                done, columns=["source_size", "source_sha256", "archive_size", "archive_sha256"], index=batch.index)
            yield pd.concat([batch[keys], measured], axis=1)

    narrow = files.select(
        *keys, files[path].alias("__path"), files[name].alias("__name"), files["size"].alias("__size"),
        files[target].alias("__target"))
    return narrow.mapInPandas(work, _schema(
        files, keys, "source_size bigint, source_sha256 string, archive_size bigint, archive_sha256 string"))
