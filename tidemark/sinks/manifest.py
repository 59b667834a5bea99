"""Staging into files that are never changed.

A batch writes one folder of files, whatever the number of ranges: rows of the ranges it touched,
those staged before included, sorted by range. Then it writes an entry per range, read back from
the files, and last it publishes the version of the manifest that names them. Until then no reader
sees any of it, and nothing has to be put back if it fails: a replay writes a folder of its own.

Every row carries the version it first appeared in, so that what changed between two versions can
be read without comparing them.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import check_width, is_complete, range_end, range_start
from tidemark.operators.bitmaps import block_of, position_of
from tidemark.operators.ranges import with_outcome
from tidemark.operators.records import now_utc, parse_envelope, records_of, staging_rows
from tidemark.schema import LAYOUT_COLUMNS, PROVENANCE, STAGED
from tidemark.session import configure
from tidemark.sinks import versions as log
from tidemark.sinks.area import ManifestArea, delete
from tidemark.sinks.ledger import batch_name
from tidemark.sinks.staging import RANGE as PLACE
from tidemark.sinks.staging import merged, placed, touched_ranges

# Besides the staged columns: the batch's folder, and the version a row first appeared in.
FILE = T.StructType(
    [*STAGED.fields, T.StructField("since", T.LongType()), T.StructField("folder", T.StringType())]
)
# In a shredded area, the payload once more. The writer finds its fields and gives each a column.
SHREDDED = T.StructType([*FILE.fields, T.StructField("fields", T.VariantType())])
KEYS = log.RANGE
# Live ranges that are sent to every task, about 100 bytes each. The driver holds them some times over.
LIVE_RANGES = 20_000


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(FILE).parquet(*paths) if paths else spark.createDataFrame([], FILE)


def _current(rows: DataFrame, live: DataFrame, ranges: int) -> DataFrame:
    """The rows whose file is the one that `live`, of so many `ranges`, has for their range.

    Few ranges are sent to every task; a join that deals rows by range would shuffle all of them.
    """
    at = live.select("topic", F.col("partition").alias("part"), "range_start", "folder")
    return rows.join(F.broadcast(at) if ranges <= LIVE_RANGES else at, at.columns, "left_semi")


def _live_rows(spark: SparkSession, area: ManifestArea, seen: log.Head, read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """What `read` makes of the folders that hold live ranges, without the rows of ranges written again."""
    live = log.live_entries(spark, area, seen, "folder")
    # A row per batch, whatever the number of ranges.
    kept = {r["folder"]: r["count"] for r in live.groupBy("folder").count().collect()}
    written = dict(seen.sizes)
    whole = [f"{area.data}/{folder}" for folder, ranges in kept.items() if ranges == written[folder]]
    partly = [f"{area.data}/{folder}" for folder, ranges in kept.items() if ranges != written[folder]]
    rows = read(whole)
    if partly:
        current = _current(read(partly), live, sum(kept.values()))
        rows = rows.unionByName(current) if whole else current
    return rows.drop("folder")


def read_rows(spark: SparkSession, area: ManifestArea, seen: log.Head | None = None) -> DataFrame:
    """All rows as of a version, with their layout columns and `since`.

    Whole folders are read as they are; only where a range was written again are its older rows left out.
    """
    configure(spark)
    return _live_rows(spark, area, seen or log.head(spark, area), lambda paths: _files(spark, paths))


def read_fields(spark: SparkSession, area: ManifestArea, seen: log.Head | None = None, **fields: tuple[str, str]) -> DataFrame:
    """Topic, partition and offset of all rows, and by name a path in the payload and its type.

    Null where the path is absent or holds another type. Of a shredded area only the columns of these paths
    are read; of another, the payload's text.
    """
    configure(spark)
    seen = seen or log.head(spark, area)
    log.check_width(seen, area, seen.width)
    source = F.col("fields") if area.shredded else F.try_parse_json("payload")

    def read(paths: list[str]) -> DataFrame:
        rows = spark.read.schema(SHREDDED).parquet(*paths) if paths else spark.createDataFrame([], SHREDDED)
        taken = [F.try_variant_get(source, path, kind).alias(name) for name, (path, kind) in fields.items()]
        return rows.select(*PLACE, "folder", *PROVENANCE, *taken)

    return _live_rows(spark, area, seen, read).select(*PROVENANCE, *fields)


def read_staging(spark: SparkSession, area: ManifestArea, seen: log.Head | None = None) -> DataFrame:
    """Staged rows with their layout columns, as of a version."""
    return read_rows(spark, area, seen).select(*STAGED.fieldNames())


def _located(held: Column) -> list[Column]:
    """Where the ranges are for which `held` is true. At most one element per file: a file holds many ranges."""
    return [
        F.collect_set(F.when(held, F.struct("folder", "file"))).alias("files"),
        F.min(F.when(held, F.col("range_start"))).alias("first"),
        F.max(F.when(held, F.col("range_end"))).alias("last"),
        F.count_if(held).alias("ranges"),
    ]


def _near(spark: SparkSession, area: ManifestArea, at: Row) -> DataFrame:
    """The rows of the located files within the located offsets: also of other ranges, and older copies."""
    rows = _files(spark, [f"{area.data}/{folder}/{file}" for folder, file in at["files"]])
    return rows.where(F.col("kafka_offset").between(at["first"], at["last"])) if at["files"] else rows


def _rows_at(spark: SparkSession, area: ManifestArea, entries: DataFrame, at: Row) -> DataFrame:
    rows = _near(spark, area, at)
    return (_current(rows, entries, at["ranges"]) if at["files"] else rows).drop("folder")


def read_ranges(spark: SparkSession, area: ManifestArea, entries: DataFrame) -> DataFrame:
    """Rows of the ranges of `entries`, from just the files that hold them. Nothing is listed."""
    configure(spark)
    return _rows_at(spark, area, entries, entries.agg(*_located(F.lit(True))).first())


def read_object(spark: SparkSession, area: ManifestArea, object_name: str, seen: log.Head | None = None) -> DataFrame:
    """The rows of the range with this contract name, from the one file that holds it."""
    topic, date, file_name = object_name.split("/")
    part, start, end = map(int, file_name.removesuffix(".parquet").split("-"))
    entries = log.live_entries(spark, area, seen or log.head(spark, area), "range_end", "dt", "folder", "file")
    named = entries.where(
        (F.col("topic") == topic) & (F.col("partition") == part) & (F.col("range_start") == start)
        & (F.col("range_end") == end) & (F.col("dt") == date.removeprefix("dt="))
    )
    found = named.first()
    rows = _files(spark, [f"{area.data}/{found['folder']}/{found['file']}"] if found else [])
    one = (F.col("topic") == topic) & (F.col("part") == part) & F.col("kafka_offset").between(start, end)
    return rows.where(one).select(*STAGED.fieldNames())


def settled_entries(spark: SparkSession, area: ManifestArea, seen: log.Head, quiet_since: datetime) -> DataFrame:
    """Entries of complete ranges, those passed by, and those that gained nothing since `quiet_since`."""
    named = log.live_entries(spark, area, seen).withColumnsRenamed({"topic": "kafka_topic", "partition": "kafka_partition"})
    settled = (F.col("outcome") != "open") | (F.col("written_at") <= F.lit(quiet_since))
    found = with_outcome(named).where(settled)
    return found.withColumnsRenamed({"kafka_topic": "topic", "kafka_partition": "partition"}).select(*log.ENTRY.fieldNames())


def read_settled(spark: SparkSession, area: ManifestArea, quiet_since: datetime) -> DataFrame:
    """Rows without fresh partial ranges."""
    rows = read_ranges(spark, area, settled_entries(spark, area, log.head(spark, area), quiet_since))
    return rows.select(*STAGED.fieldNames())


def publish_settled(
    spark: SparkSession, staged: ManifestArea, published: ManifestArea, quiet_since: datetime, lease: log.Lease | None = None
) -> log.Version | None:
    """Copy the settled ranges of `staged` of which `published` lacks rows, as one version of `published`."""
    lease = lease or log.claim(spark, published, "settled")
    source, seen = log.head(spark, staged), log.head(spark, published)
    log.check(seen, lease, published)
    if source.width is None:
        return None
    log.check_width(seen, published, source.width)
    known = log.live_entries(spark, published, seen, "range_end", "records", "folder", "file")
    wanted = settled_entries(spark, staged, source, quiet_since).alias("s").join(known.alias("p"), KEYS, "left")
    wanted = wanted.where(F.coalesce("p.records", F.lit(0)) < F.col("s.records"))
    fresh = wanted.select(*KEYS, "s.range_end", "s.records", "s.folder", "s.file").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = fresh.agg(F.sum("records")).first()[0]
        if not count:
            return None
        version = log.next_version(
            seen, lease, "batch", batch_id=seen.batch_id + 1, width=source.width, shredded=published.shredded
        )
        version = replace(version, batch=batch_name(lease.writer, version.batch_id, f"{source.number:016x}"))
        new = read_ranges(spark, staged, fresh).withColumn("since", F.lit(version.number).cast("bigint"))
        held = read_ranges(spark, published, known.join(fresh.select(*KEYS), KEYS, "left_semi"))
        folder = _new_folder(version)
        _write(merged(new, held, source.width, count, "since").withColumn("folder", F.lit(folder)), published, folder)
        version = _describe(spark, published, folder, version, source.width)
    finally:
        fresh.unpersist()
    return commit_batch(spark, published, Prepared(seen, version))


def changes(spark: SparkSession, area: ManifestArea, after: int, through: int | None = None) -> DataFrame:
    """The rows that appeared after version `after`, up to `through` or now: each staged row once over
    all increments. Only files of ranges that were written in between are read.

    A change of width writes rows again without adding any.
    """
    seen = log.head(spark, area, through)
    if seen.number <= after:
        return _files(spark, []).drop("folder")
    changed = log.live_entries(spark, area, seen, "range_end", "version", "folder", "file").where(F.col("version") > after)
    return read_ranges(spark, area, changed).where(F.col("since") > after)


def _plan(touched: DataFrame, area: ManifestArea, seen: log.Head, width: int) -> DataFrame:
    """The touched ranges, with what the manifest has of them."""
    known = log.live_entries(touched.sparkSession, area, seen, "records", "folder", "file")
    end = range_end(F.col("range_start"), width).alias("range_end")
    return touched.join(known, KEYS, "left").select("*", end, F.col("folder").isNotNull().alias("was_staged"))


def _total(plan: DataFrame) -> Row:
    """What the driver needs to know of a batch, in one row whatever the number of ranges."""
    named = F.xxhash64(*KEYS, "arrived", "first_offset", "last_offset", "offsets").cast("decimal(38,0)")
    return plan.agg(
        F.sum(named).alias("fingerprint"),
        F.coalesce(F.sum("arrived"), F.lit(0)).alias("arrived"),
        F.coalesce(F.max("was_staged"), F.lit(False)).alias("was_staged"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("held"),
        *_located(F.col("was_staged")),
    ).first()


def _new_folder(version: log.Version) -> str:
    return f"{version.number:020d}-{version.epoch}-{uuid.uuid4().hex}"


def _write(rows: DataFrame, area: ManifestArea, folder: str) -> None:
    whole = rows.select(*FILE.fieldNames())
    if area.shredded:
        # After the sort, so that no shuffle carries it.
        whole = whole.withColumn("fields", F.try_parse_json("payload"))
    whole.write.option("compression", "zstd").parquet(f"{area.data}/{folder}")


def _describe(spark: SparkSession, area: ManifestArea, folder: str, version: log.Version, width: int) -> log.Version:
    """Write the entries of a folder, read back from its files, and count them into `version`. A batch that
    brought nothing new has no folder."""
    rows = _files(spark, [f"{area.data}/{folder}"])
    name = F.col("_metadata.file_name").alias("file")
    blocks = (
        rows.select(*LAYOUT_COLUMNS, "kafka_offset", "malformed", "ingested_at", name)
        .groupBy("topic", "part", "range_start", "dt", "file", block_of("kafka_offset").alias("bucket"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.max("kafka_offset").alias("last_offset"),
            F.count_if("malformed").alias("malformed"),
            F.max("ingested_at").alias("written_at"),
            F.bitmap_construct_agg(position_of("kafka_offset")).alias("bits"),
        )
    )
    entries = (
        blocks.groupBy("topic", F.col("part").alias("partition"), "range_start", "dt", "file")
        .agg(
            F.sum("records").alias("records"),
            F.max("last_offset").alias("last_offset"),
            F.sum("malformed").alias("malformed"),
            F.max("written_at").alias("written_at"),
            F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("offsets"),
        )
        .withColumns(
            {
                "range_end": range_end(F.col("range_start"), width),
                "batch_id": F.lit(version.batch_id).cast("bigint"),
                "version": F.lit(version.number).cast("bigint"),
                "folder": F.lit(folder),
            }
        )
    )
    counted = Observation(f"entries-{folder}")
    complete = is_complete(F.col("last_offset"), F.col("range_end"))
    counts = [F.count(F.lit(1)).alias("uploads"), F.count_if(complete).alias("commits")]
    entries.select(*log.ENTRY.fieldNames()).observe(counted, *counts).write.parquet(f"{area.entries}/{folder}")
    uploads, commits = counted.get["uploads"], counted.get["commits"]
    if not uploads:
        delete(spark, f"{area.entries}/{folder}")
        delete(spark, f"{area.data}/{folder}")
        return version
    return replace(version, folder=folder, uploads=uploads, commits=commits, partial_uploads=uploads - commits)


@dataclass(frozen=True)
class Prepared:
    """A batch whose files are written and which no reader sees yet."""

    seen: log.Head
    version: log.Version


def prepare_batch(
    wire: DataFrame,
    batch_id: int,
    area: ManifestArea,
    width: int,
    lease: log.Lease,
    now: datetime | None = None,
    keep: bool = False,
) -> Prepared | None:
    """Write the files and entries of a batch, or nothing if it is empty or the writer's last one once more.

    Fails with `Fenced` if another writer has claimed the area since the lease.
    """
    check_width(width)
    spark = configure(wire.sparkSession)
    seen = log.head(spark, area)
    log.check(seen, lease, area)
    log.check_width(seen, area, width)
    if keep:
        wire = wire.persist(StorageLevel.MEMORY_AND_DISK)
    plan = _plan(touched_ranges(wire, width), area, seen, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = _total(plan)
        if not total["arrived"]:
            return None
        name = batch_name(lease.writer, batch_id, f"{int(total['fingerprint']) % (1 << 64):016x}")
        if dict(seen.batches).get(lease.writer) == name:
            return None
        version = log.next_version(seen, lease, "batch", batch=name, batch_id=batch_id, width=width, shredded=area.shredded)
        return Prepared(seen, _stage(wire, plan, total, area, version, width, now or now_utc()))
    finally:
        plan.unpersist()
        if keep:
            wire.unpersist()


def commit_batch(spark: SparkSession, area: ManifestArea, prepared: Prepared) -> log.Version:
    """Publish a prepared batch, whole or not at all. Fails with `Fenced` if the area was claimed meanwhile."""
    log.snapshot_if_long(spark, area, log.publish(spark, area, prepared.seen, prepared.version))
    return prepared.version


def stage_batch(
    wire: DataFrame,
    batch_id: int,
    area: ManifestArea,
    width: int,
    lease: log.Lease | None = None,
    now: datetime | None = None,
    keep: bool = False,
) -> log.Version | None:
    """Stage the messages of `wire` as batch `batch_id` of the lease's writer, if there are any.

    Returns the version published, or nothing if there was nothing to do. Without a lease the area is
    claimed for this call. `keep` holds the raw messages on the executors while the batch runs, for a
    source that is costly to read twice.
    """
    lease = lease or log.claim(wire.sparkSession, area, "batch")
    prepared = prepare_batch(wire, batch_id, area, width, lease, now, keep)
    return commit_batch(wire.sparkSession, area, prepared) if prepared else None


def _stage(
    wire: DataFrame, plan: DataFrame, total: Row, area: ManifestArea, version: log.Version, width: int, now: datetime
) -> log.Version:
    spark = wire.sparkSession
    written_at = F.lit(now).cast("timestamp")
    write_date = now.astimezone(timezone.utc).strftime("%Y-%m-%d")
    rows = staging_rows(parse_envelope(records_of(wire)), written_at)
    incoming = placed(rows, width, write_date).withColumn("since", F.lit(version.number).cast("bigint"))
    carried = None
    if total["was_staged"]:
        carried = _near(spark, area, total)
        # Few ranges spare the shuffle what else is in their files. Of many, `merged` leaves it out.
        if total["ranges"] <= LIVE_RANGES:
            carried = _current(carried, plan.where("was_staged"), total["ranges"])
    folder = _new_folder(version)
    counted = Observation(f"rows-{folder}")
    whole = merged(incoming, carried, width, total["arrived"] + total["held"], "since", counted=counted)
    whole = whole.withColumn("folder", F.lit(folder))
    _write(whole, area, folder)
    return _describe(spark, area, folder, replace(version, **counted.get), width)


def stage_log(
    wire: DataFrame, area: ManifestArea, width: int, now: datetime | None = None, batch_id: int | None = None
) -> log.Version | None:
    """Stage a bounded log. Run it again and no row changes."""
    spark = configure(wire.sparkSession)
    lease = log.claim(spark, area, "batch")
    if batch_id is None:
        batch_id = log.head(spark, area).batch_id + 1
    return stage_batch(wire, batch_id, area, width, lease, now)


def retile(spark: SparkSession, area: ManifestArea, width: int, lease: log.Lease | None = None) -> log.Version | None:
    """Move all staged rows into ranges of another width, as one version. What is committed stays so.

    Rows keep the offsets, times and versions they have. A new range takes the earliest date of the ranges
    it joins. Readers of older versions still find the old files.
    """
    check_width(width)
    configure(spark)
    lease = lease or log.claim(spark, area, "retile")
    seen = log.head(spark, area)
    log.check(seen, lease, area)
    if seen.width in (None, width):
        return None
    version = log.next_version(seen, lease, "retile", width=width, batch_id=seen.batch_id)
    start: Column = range_start(F.col("kafka_offset"), width)
    rows = read_rows(spark, area, seen).withColumn("range_start", start)
    entries = log.live_entries(spark, area, seen, "range_end", "dt", "records")
    # Each old range lies in one new range, or over some: a row per pair, by the widths alone.
    first, last = (F.col(c) - F.col(c) % F.lit(width).cast("bigint") for c in ("range_start", "range_end"))
    new = F.explode(F.sequence(first, last, F.lit(width).cast("bigint"))).alias("new_start")
    dates = entries.select("topic", F.col("partition").alias("part"), "dt", new).groupBy("topic", "part", "new_start")
    dates = dates.agg(F.min("dt").alias("dt")).withColumnRenamed("new_start", "range_start")
    rows = rows.drop("dt").join(dates, PLACE)
    folder = _new_folder(version)
    count = entries.agg(F.sum("records")).first()[0] or 0
    whole = merged(rows, None, width, count, "since").withColumn("folder", F.lit(folder))
    _write(whole, area, folder)
    version = _describe(spark, area, folder, version, width)
    log.publish(spark, area, seen, version)
    return version


__all__ = ["changes", "commit_batch", "prepare_batch", "publish_settled", "read_fields", "read_object", "read_ranges", "read_rows", "read_settled", "read_staging", "retile", "stage_batch", "stage_log"]
