"""Which files may hold an event id: Bloom filters of the files of a `ManifestArea`.

The filter of a file is cut into blocks of 32,768 bits, as many as its rows ask for. An event id sets
`PROBES` bits of one block, so to look it up is to join it with that block of each file, and the index
is read by block number instead of whole. Files never change, so an index is never out of date; files
without one are opened.
"""

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.bitmaps import BLOCK
from tidemark.schema import STAGED
from tidemark.session import configure
from tidemark.sinks import manifest
from tidemark.sinks import versions as log
from tidemark.sinks.area import ManifestArea, children, put_if_absent, read_text

PROBES = 7
# Ten bits for each id, so about one lookup in a hundred opens a file for nothing.
IDS_PER_BLOCK = BLOCK // 10
SCHEMA = "folder string, file string, blocks int, block int, bits binary"


def _block(event_id: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(event_id, F.lit("block")), blocks).cast("int")


def _probes(event_id: Column) -> Column:
    """The bits of an id, as places in its block."""
    first, step = F.xxhash64(event_id, F.lit("first")), F.xxhash64(event_id, F.lit("step")).bitwiseOR(F.lit(1).cast("bigint"))
    places = [(first.bitwiseAND(F.lit(BLOCK - 1)) + n * step.bitwiseAND(F.lit(BLOCK - 1))) % BLOCK for n in range(PROBES)]
    return F.array(*places)


def _lists(spark: SparkSession, area: ManifestArea) -> dict[str, list[str]]:
    """By index folder, the data folders it covers. A list is written last, so a broken index is not seen."""
    names = [name for name in children(spark, area.index) if name.endswith(".json") and name[:1] != "."]
    return {name.removesuffix(".json"): json.loads(read_text(spark, f"{area.index}/{name}"))["folders"] for name in names}


def build(spark: SparkSession, area: ManifestArea) -> list[str]:
    """Index the live files that have no index yet; return their folders. Reads one column of them."""
    configure(spark)
    covered = {folder for folders in _lists(spark, area).values() for folder in folders}
    live = log.live_entries(spark, area, log.head(spark, area), "folder")
    # A row per batch, whatever the number of ranges.
    missing = sorted({r["folder"] for r in live.select("folder").distinct().collect()} - covered)
    if not missing:
        return []
    rows = spark.read.schema(manifest.FILE).parquet(*[f"{area.data}/{folder}" for folder in missing])
    ids = rows.where("event_id IS NOT NULL").select("folder", F.col("_metadata.file_name").alias("file"), "event_id")
    # As few different numbers of blocks as powers of two: a lookup hashes an id once for each.
    needed = F.ceil(F.log2(F.greatest(F.count(F.lit(1)) / IDS_PER_BLOCK, F.lit(1.0))))
    sized = ids.groupBy("folder", "file").agg(F.pow(F.lit(2), needed).cast("int").alias("blocks"))
    block = _block(F.col("event_id"), F.col("blocks")).alias("block")
    bits = ids.join(sized, ["folder", "file"]).select("folder", "file", "blocks", block, F.explode(_probes(F.col("event_id"))).alias("bit"))
    filters = bits.groupBy("folder", "file", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    name = uuid.uuid4().hex
    filters.repartitionByRange("blocks", "block").sortWithinPartitions("blocks", "block").write.parquet(f"{area.index}/{name}")
    put_if_absent(spark, f"{area.index}/{name}.json", json.dumps({"folders": missing, "token": name}))
    return missing


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def candidates(spark: SparkSession, area: ManifestArea, event_ids: DataFrame) -> DataFrame:
    """`event_id, folder, file`: indexed files that may hold each id of `event_ids`."""
    lists = _lists(spark, area)
    if not lists:
        return spark.createDataFrame([], "event_id string, folder string, file string")
    index = spark.read.schema(SCHEMA).parquet(*[f"{area.index}/{name}" for name in lists])
    asked = event_ids.select("event_id").where("event_id IS NOT NULL").distinct()
    # The few numbers of blocks that files have.
    sizes = [r["blocks"] for r in index.select("blocks").distinct().collect()]
    sized = asked.withColumn("blocks", F.explode(F.array(*[F.lit(size) for size in sizes]) if sizes else F.array().cast("array<int>")))
    placed = sized.withColumn("block", _block(F.col("event_id"), F.col("blocks"))).withColumn("places", _probes(F.col("event_id")))
    met = index.join(placed, ["blocks", "block"])
    return met.where(F.forall("places", lambda place: _is_set(F.col("bits"), place))).select("event_id", "folder", "file")


def trace(spark: SparkSession, area: ManifestArea, event_ids: DataFrame) -> DataFrame:
    """Staged rows of the given event ids: only files that may hold one are opened."""
    configure(spark)
    seen = log.head(spark, area)
    live = log.live_entries(spark, area, seen, "range_end", "folder", "file")
    covered = [folder for folders in _lists(spark, area).values() for folder in folders]
    found = candidates(spark, area, event_ids).select("folder", "file").distinct()
    unknown = live.where(~F.col("folder").isin(covered)).select("folder", "file").distinct()
    files = found.unionByName(unknown).distinct()
    rows = manifest.read_ranges(spark, area, live.join(files, ["folder", "file"], "left_semi"))
    asked = event_ids.select("event_id").distinct()
    return rows.join(asked, "event_id", "left_semi").select(*STAGED.fieldNames())
