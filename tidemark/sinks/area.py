"""Where a staging area keeps its parts, and the few file operations Spark has no call for."""

import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class StagingArea:
    """A staging area of one folder per range, written and pruned by Spark alone.

    `data` is what readers see. `ledger` says what is committed. `intents` and `carried`
    belong to the batch in flight and make its replay repeat the same writes. `claims` names
    the writer at work and `widths` the width of all ranges."""

    root: str

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def batches(self) -> str:
        return f"{self.root}/ledger/batches"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/ledger/snapshots"

    @property
    def intents(self) -> str:
        return f"{self.root}/intents"

    @property
    def carried(self) -> str:
        return f"{self.root}/carried"

    @property
    def claims(self) -> str:
        return f"{self.root}/claims"

    @property
    def widths(self) -> str:
        return f"{self.root}/widths"

    def range_path(self, topic: str, dt: str, part: int, range_start: int, range_end: int) -> str:
        return f"{self.data}/topic={topic}/dt={dt}/part={part}/range_start={range_start}"

    def day_path(self, topic: str, dt: str) -> str:
        return f"{self.data}/topic={topic}/dt={dt}"


class ObjectArea(StagingArea):
    """An area of one file per range under its contract name, for readers outside Spark and
    for backfills of very many ranges: each task puts its objects in place itself, whereas
    folders are put in place one after another when the job commits."""

    def range_path(self, topic: str, dt: str, part: int, range_start: int, range_end: int) -> str:
        return f"{self.data}/{topic}/dt={dt}/{part}-{range_start}-{range_end}.parquet"

    def day_path(self, topic: str, dt: str) -> str:
        return f"{self.data}/{topic}/dt={dt}"


@dataclass(frozen=True)
class ManifestArea:
    """An area whose files are never changed: which of them hold a range is in a versioned manifest.

    `data` and `entries` have a folder per batch, `versions` a small file per version,
    `snapshots` the whole manifest every so many versions, and `index` filters over event ids.

    In a `shredded` area files also hold the payload as a variant, whose fields are columns of the file.
    The first batch decides; opened the other way, the area is refused."""

    root: str
    shredded: bool = False

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def entries(self) -> str:
        return f"{self.root}/entries"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    @property
    def versions(self) -> str:
        return f"{self.root}/versions"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshots"


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to `path` ran to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _file_system(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def file_stamps(spark: SparkSession, paths: list[str]) -> tuple[tuple[str, int, int], ...]:
    """Path, length and time of change of each file."""
    stamps = []
    for path in sorted(paths):
        fs, jpath = _file_system(spark, path)
        status = fs.getFileStatus(jpath)
        stamps.append((path, status.getLen(), status.getModificationTime()))
    return tuple(stamps)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make the file with all of its text at once, unless it is there. `text` must be unique to the call.

    The text goes to a file of its own, which then takes its name only if no other has it: a link on a
    local disk, a rename without overwriting elsewhere. A store must rename one file atomically.
    """
    fs, target = _file_system(spark, path)
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    source, named = (fs.makeQualified(p).toUri() for p in (draft, target))
    try:
        if named.getScheme() == "file":
            jvm.java.nio.file.Files.createLink(jvm.java.nio.file.Paths.get(named), jvm.java.nio.file.Paths.get(source))
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(named, spark._jsc.hadoopConfiguration())
            no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            files.rename(draft, target, no_options)
    except Py4JJavaError:
        if not fs.exists(target):
            raise
    finally:
        fs.delete(draft, False)
    # An answer may be lost where the file was made: what stands there decides.
    return read_text(spark, path) == text
