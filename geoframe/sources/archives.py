"""Binary files as a sink and zip archives as a source of Spark, by its Python data source interface."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as csv
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from geoframe.functions.times import ntz

#: Bytes of a member that are decoded at once.
BLOCK = 1 << 20


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, which may be a URI, and the path there."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class _FilesWriter(DataSourceWriter):
    """Tasks write under names of their own in a hidden folder; only the commit of the whole job moves files to their places."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.pending = path.rstrip("/"), overwrite, f"_pending-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> _Written:
        store, root = _file_system(self.path)
        files = []
        store.create_dir(f"{root}/{self.pending}", recursive=True)
        for row in iterator:
            held = f"{self.pending}/{uuid.uuid4().hex}"
            with store.open_output_stream(f"{root}/{held}") as out:
                out.write(row.content or b"")
            files.append((held, row.path))
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        store, root = _file_system(self.path)
        if self.overwrite:
            for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if not x.base_name.startswith("_pending"):
                    store.delete_dir(x.path) if x.type == fs.FileType.Directory else store.delete_file(x.path)
        for folder in {f"{root}/{p}".rpartition("/")[0] for m in messages if m for _, p in m.files}:
            store.create_dir(folder, recursive=True)
        for message in messages:
            for held, path in message.files if message else []:
                store.move(f"{root}/{held}", f"{root}/{path}")
        self._clear(store, root)

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear(*_file_system(self.path))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(f"{root}/{self.pending}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.pending}")


class BinaryFiles(DataSource):
    """Sink: a file for each row of (path, content), path below that of the write; nothing is seen before all are written."""

    @classmethod
    def name(cls) -> str:
        return "binary_files"

    def writer(self, schema, overwrite: bool) -> _FilesWriter:
        if not {"path", "content"} <= set(schema.fieldNames()):
            raise ValueError("rows of (path, content) are needed")
        return _FilesWriter(self.options["path"], overwrite)


@dataclass
class _Archive(InputPartition):
    path: str


class _Seekable(io.RawIOBase):
    """A file of a file system for readers that expect an OSError where a position is before its beginning."""

    def __init__(self, file: pa.NativeFile):
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self.file.seek(offset, whence)
        except pa.ArrowInvalid as error:
            raise OSError(str(error)) from error

    def tell(self) -> int:
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


class _MembersReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.prefix, self.suffix, self.columns = options["path"], options.get("prefix", ""), options.get("suffix", ".tsv"), columns
        self.station = options.get("station", "all")

    def partitions(self) -> list[_Archive]:
        store, root = _file_system(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        return [_Archive(x.path) for x in sorted(found, key=lambda x: x.path) if x.type == fs.FileType.File and x.path.endswith(".zip") and "/_pending-" not in x.path]

    def wanted(self, name: str) -> bool:
        base = name.rsplit("/", 1)[-1]
        return base.startswith(self.prefix) and base.endswith(self.suffix) and (self.station == "all" or base[6:8] == self.station)

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        names = ["path", "member", "error", *self.columns]
        failed = lambda member, error: pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (partition.path, member, f"{type(error).__name__}: {error}", *[None] * len(self.columns))], names)
        read, parse = csv.ReadOptions(column_names=self.columns, block_size=BLOCK), csv.ParseOptions(delimiter="\t")
        convert = csv.ConvertOptions(column_types={c: pa.string() for c in self.columns}, strings_can_be_null=True)
        store, _ = _file_system(self.path)
        try:
            with store.open_input_file(partition.path) as raw, zipfile.ZipFile(io.BufferedReader(_Seekable(raw), BLOCK)) as archive:
                for info in archive.infolist():
                    if not self.wanted(info.filename):
                        continue
                    try:
                        if info.file_size:
                            with archive.open(info) as member:
                                for batch in csv.open_csv(member, read, parse, convert):
                                    same = [pa.array([x] * batch.num_rows, pa.string()) for x in (partition.path, info.filename, None)]
                                    yield pa.RecordBatch.from_arrays([*same, *batch.columns], names)
                    except (zipfile.BadZipFile, pa.ArrowInvalid) as error:
                        yield failed(info.filename, error)
        except zipfile.BadZipFile as error:
            yield failed(None, error)


class ZipMembers(DataSource):
    """Source: rows of delimited members of zip archives at any depth under a path, one partition an archive, members read in blocks.

    Options: path, prefix and suffix of member names, station (characters 7 and 8 of the name, or all),
    columns (a comma list). Values are text. An archive or member that can't be read gives one row with
    its error.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    @property
    def columns(self) -> list[str]:
        return self.options["columns"].split(",")

    def schema(self) -> str:
        return ", ".join(f"`{c}` string" for c in ["path", "member", "error", *self.columns])

    def reader(self, schema) -> _MembersReader:
        return _MembersReader(dict(self.options), self.columns)


def register(spark: SparkSession) -> SparkSession:
    """Makes both formats known to the session."""
    spark.dataSource.register(BinaryFiles)
    spark.dataSource.register(ZipMembers)
    return spark


def write_files(df: DataFrame, path: str, mode: str = "append") -> str:
    """Writes (path, content) rows as files under a path, all or none."""
    register(df.sparkSession)
    df.select("path", "content").write.format("binary_files").mode(mode).save(path)
    return path


def station_members(spark: SparkSession, path: str, prefix: str, columns: list[str], station: str = "all") -> DataFrame:
    """(path, station int, time, variable, value, error) of the TSV members whose name begins with a prefix, by variable, without missing values.

    Damaged archives and members are rows with an error; times and values that can't be read are null
    and their text is in the error, so nothing gets lost unseen.
    """
    read = register(spark).read.format("zip_members").option("prefix", prefix).option("station", station).option("columns", ",".join(["time", *columns])).load(path)
    variables = F.array(*(F.struct(F.lit(c).alias("variable"), F.col(c).alias("text")) for c in columns))
    each: Column = F.when(F.col("error").isNull(), variables).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("variable"), F.lit(None).cast("string").alias("text"))))
    long = read.select("path", F.regexp_extract("member", r"([^/]*)$", 1).substr(7, 2).try_cast("int").alias("station"), "time", "error", F.explode(each).alias("v"))
    value, time = F.col("v.text").try_cast("double"), ntz(F.try_to_timestamp("time"))
    bad = F.when(value.isNull(), F.concat(F.lit("not a number: "), F.col("v.text"))).when(time.isNull(), F.concat(F.lit("not a time: "), F.coalesce("time", F.lit("null"))))
    return long.where(F.col("error").isNotNull() | F.col("v.text").isNotNull()).select("path", "station", time.alias("time"), "v.variable", value.alias("value"), F.coalesce("error", bad).alias("error"))
