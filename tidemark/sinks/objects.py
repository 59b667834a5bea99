"""Objects under their exact names, for readers outside Spark.

Spark picks the names of the files it writes. Here each range becomes one file
`{topic}/dt={date}/{partition}-{start}-{end}.parquet` with the contract's own types, among
them a broker timestamp in milliseconds. Spark shuffles and sorts the rows; a task only
cuts its Arrow batches where the name changes.
"""

import posixpath
import sys
import uuid
from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import DataType, StructField, StructType

from tidemark.functions import object_name, range_end
from tidemark.schema import LAYOUT, LAYOUT_COLUMNS, STAGED, STAGING
from tidemark.sinks.area import children

if TYPE_CHECKING:
    import pyarrow as pa

FORMAT = "tidemark_objects"
ZSTD_LEVEL = 3
# Uncompressed Arrow bytes after which a row group is written.
ROW_GROUP_BYTES = 64 << 20
# Objects that one task opens by their names, besides the tasks the session asks for anyway, and the rows it passes on at once.
OBJECTS_PER_TASK, ROWS_AT_ONCE = 2_000, 10_000


def arrow_type(kind: DataType, unit: str = "us") -> "pa.DataType":
    import pyarrow as pa

    if kind.typeName() == "timestamp":
        return pa.timestamp(unit, "UTC")
    return {"string": pa.string(), "integer": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[kind.typeName()]


def contract_schema() -> "pa.Schema":
    import pyarrow as pa

    return pa.schema(
        [pa.field(f.name, arrow_type(f.dataType, "ms" if f.name == "kafka_timestamp" else "us"), f.nullable) for f in STAGING.fields]
    )


def _store(root: str):
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        # Arrow knows Hadoop's `s3a` as `s3`.
        return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), root


class ObjectWriter(DataSourceArrowWriter):
    """Writes each run of equal names as one object. The names depend on keys only, so a
    retried or duplicate task replaces an object by itself."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator: Iterator["pa.RecordBatch"]) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.compute as pc

        target, base = _store(self.root)
        current = None
        for batch in iterator:
            runs = pc.run_end_encode(batch.column("object_name"))
            start = 0
            for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                if current is None or current.name != name:
                    if current is not None:
                        current.finish()
                    current = OpenObject(target, base, name)
                current.add(pa.Table.from_batches([batch.slice(start, end - start)]))
                start = end
        if current is not None:
            current.finish()
        return WriterCommitMessage()


class OpenObject:
    """The one object a task is writing. Rows leave in row groups of bounded size, so the width
    of a range does not decide how much a task holds."""

    def __init__(self, target, base: str, name: str):
        import pyarrow.parquet as pq
        from pyarrow import fs

        self.target, self.name, self.path = target, name, posixpath.join(base, name)
        # An object store shows an object when it is whole; a file system needs a rename.
        self.renames = isinstance(target, (fs.LocalFileSystem, fs.HadoopFileSystem))
        self.written = self.path
        if self.renames:
            folder, file_name = posixpath.split(self.path)
            self.written = f"{folder}/.{file_name}.{uuid.uuid4().hex}"
            target.create_dir(folder, recursive=True)
        self.schema = contract_schema()
        self.out = target.open_output_stream(self.written)
        self.file = pq.ParquetWriter(self.out, self.schema, compression="zstd", compression_level=ZSTD_LEVEL)
        self.pieces, self.held = [], 0

    def add(self, piece: "pa.Table") -> None:
        self.pieces.append(piece)
        self.held += piece.nbytes
        if self.held >= ROW_GROUP_BYTES:
            self._write()

    def _write(self) -> None:
        import pyarrow as pa

        if self.pieces:
            self.file.write_table(pa.concat_tables(self.pieces).drop_columns(["object_name"]).cast(self.schema))
        self.pieces, self.held = [], 0

    def finish(self) -> None:
        self._write()
        self.file.close()
        self.out.close()
        if self.renames:
            self.target.move(self.written, self.path)


class ObjectSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options["path"])


def put_objects(rows: DataFrame, root: str) -> None:
    """Put each range of `rows` as one object below `root`, replacing its former version.

    A range must lie in one partition of the frame, in offset order.
    """
    # The writer travels with the job, so that executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows.sparkSession.dataSource.register(ObjectSource)
    name = object_name(F.col("topic"), F.col("part"), F.col("dt"), F.col("range_start"), F.col("range_end"))
    named = rows.select(*STAGING.fieldNames(), name.alias("object_name"))
    named.write.format(FORMAT).mode("overwrite").save(root)


def publish_objects(rows: DataFrame, root: str, width: int) -> None:
    """Export staged `rows`, which must hold ranges whole, as objects below `root`."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = rows.repartition(tasks, "topic", "part", "range_start", "dt")
    ordered = whole.sortWithinPartitions(*LAYOUT_COLUMNS, "kafka_offset")
    put_objects(ordered.withColumn("range_end", range_end(F.col("range_start"), width)), root)


def read_objects(spark: SparkSession, root: str, *paths: str) -> DataFrame:
    """Rows of the objects below `root`, or of those named, with their layout columns.

    Each topic is read by itself, so that a filter on `dt` prunes its folders.
    """
    stored = StructType([*STAGING.fields, LAYOUT["dt"]])
    by_topic: dict[str, list[str]] = {}
    for path in paths or [f"{root}/{topic}" for topic in children(spark, root)]:
        by_topic.setdefault(path.removeprefix(f"{root}/").split("/")[0], []).append(path)
    rows = spark.createDataFrame([], STAGED)
    start = F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(2))
    for topic, found in by_topic.items():
        of_topic = spark.read.schema(stored).option("basePath", f"{root}/{topic}").parquet(*found)
        rows = rows.unionByName(
            of_topic.select(
                *STAGING.fieldNames(),
                F.col("kafka_topic").alias("topic"),
                "dt",
                F.col("kafka_partition").alias("part"),
                start.cast("bigint").alias("range_start"),
            )
        )
    return rows


def read_named(ranges: DataFrame, root: str, columns: list[str], count: int) -> DataFrame:
    """These staged columns of the `count` objects of `ranges` (layout columns and `range_end`), those that are there.

    Names follow from the keys, so nothing is listed: each task opens its objects one after another. A small object
    costs Spark's reader far more to set up than to read.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = StructType([StructField(f.name, f.dataType) for f in STAGED.fields if f.name in columns])
    stored = [f.name for f in schema.fields if f.name not in LAYOUT_COLUMNS]

    def rows(batches: Iterator["pa.RecordBatch"]) -> Iterator["pa.RecordBatch"]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, base = _store(root)
        target = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    source = store.open_input_file(posixpath.join(base, row["object_name"]))
                except FileNotFoundError:
                    continue
                with source:
                    file = pq.ParquetFile(source)
                    for group in range(file.num_row_groups):
                        table = file.read_row_group(group, columns=stored, use_threads=False)
                        place = {c: pa.repeat(pa.scalar(row[c], target.field(c).type), table.num_rows) for c in LAYOUT_COLUMNS if c in columns}
                        held.append(pa.Table.from_arrays([place[c] if c in place else table.column(c) for c in target.names], target.names))
                        size += table.num_rows
                        if size >= ROWS_AT_ONCE:
                            yield from pa.concat_tables(held).cast(target).combine_chunks().to_batches()
                            held, size = [], 0
        if held:
            yield from pa.concat_tables(held).cast(target).combine_chunks().to_batches()

    name = object_name(F.col("topic"), F.col("part"), F.col("dt"), F.col("range_start"), F.col("range_end"))
    named = ranges.select(*LAYOUT_COLUMNS, name.alias("object_name")).distinct()
    tasks = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return named.repartition(max(tasks, -(-count // OBJECTS_PER_TASK)), "object_name").mapInArrow(rows, schema)
