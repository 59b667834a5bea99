"""What changed in a `ManifestArea`, as a stream.

The offsets of the stream are versions of the manifest. An increment reads the files that were
written since its beginning, and from each of them the rows that appeared with its version. So each
staged row comes once, in whatever order ranges were written again, and nothing has to be known of the
ranges. A change of width writes all rows again: files before it are left out, and from its own come the
rows that appeared since the beginning.
"""

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.schema import STAGED
from tidemark.sinks.area import ManifestArea

if TYPE_CHECKING:
    import pyarrow as pa

FORMAT = "tidemark_changes"
SCHEMA = StructType([*STAGED.fields, StructType().add("since", "long")["since"]])


@dataclass
class ChangedFile(InputPartition):
    """A file, and the versions of which its rows are wanted."""

    path: str
    after: int
    through: int


def _open(root: str):
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        # Arrow knows Hadoop's `s3a` as `s3`.
        return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), root


class ChangeReader(DataSourceStreamReader):
    def __init__(self, root: str, first: int):
        self.root, self.first = root, first

    def _numbers(self) -> list[int]:
        from pyarrow import fs

        store, base = _open(self.root)
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{base}/versions", allow_not_found=True))]
        return sorted(int(n.removesuffix(".json")) for n in names if n[:1] != "." and n.endswith(".json"))

    def initialOffset(self) -> dict:
        return {"version": self.first}

    def latestOffset(self) -> dict:
        return {"version": max([self.first, *self._numbers()])}

    def partitions(self, start: dict, end: dict) -> list[ChangedFile]:
        from pyarrow import fs

        after, through = start["version"], end["version"]
        store, base = _open(self.root)
        known = set(self._numbers())
        # Each folder with the versions of which its rows are wanted.
        folders: list[tuple[str, int, int]] = []
        for number in range(after + 1, through + 1):
            if number not in known:
                raise ValueError(f"version {number} of {self.root} has expired: read the area anew")
            with store.open_input_stream(f"{base}/versions/{number:020d}.json") as stream:
                version = json.loads(stream.read())
            retiled = version["kind"] == "retile"
            if retiled:
                folders = []
            if version["folder"]:
                folders.append((version["folder"], after if retiled else number - 1, number))
        return [
            ChangedFile(found.path, first, last)
            for folder, first, last in folders
            for found in sorted(store.get_file_info(fs.FileSelector(f"{base}/data/{folder}")), key=lambda f: f.base_name)
            if found.base_name[:1] not in "._" and found.base_name.endswith(".parquet")
        ]

    def read(self, partition: ChangedFile) -> Iterator["pa.RecordBatch"]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        store, _ = _open(self.root)
        columns = SCHEMA.fieldNames()
        with store.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=columns):
                keep = pc.and_(pc.greater(batch["since"], partition.after), pc.less_equal(batch["since"], partition.through))
                found = batch.filter(keep).select(columns)
                if found.num_rows:
                    yield found

    def commit(self, end: dict) -> None:
        """Nothing to give back: versions stay until they expire."""


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return SCHEMA

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(self.options["path"], int(self.options.get("startingVersion", "0")))


def read_changes(spark: SparkSession, area: ManifestArea, after: int = 0) -> DataFrame:
    """A stream of the rows that appeared after version `after`, with `since`, the version they did in."""
    # The reader travels with the job, so that executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeSource)
    return spark.readStream.format(FORMAT).option("startingVersion", str(after)).load(area.root)
