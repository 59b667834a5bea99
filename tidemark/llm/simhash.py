"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits that differ in at most three have a 31-bit half (bits 0-30 or 31-61)
that differs in at most one. The anchors of a half are the words of the perfect Hamming
(31, 26) code, whose covering radius is one. Each distinct fingerprint goes to every anchor
within covering radius plus threshold (1 + 1) of each half: one anchor if the half is itself
a code word, else sixteen. Any two linked fingerprints meet at an anchor, where whole
fingerprints are compared.

Equal fingerprints are one row before anything is replicated. An anchor with many members is
not compared in place: its members are dealt again by the anchor and each of four pieces of
the other bits, one of which linked members share. Members of an anchor are linked by a
spanning forest, not by all pairs.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.session import scratch_dir

SHINGLE = 3
DISTANCE = 3
SEED = 42
HALF = 31
# Members of an anchor that are compared in the task that holds the anchor.
ANCHOR_MEMBERS = 4096
# The pieces of the 33 bits outside a half: a pair within three bits agrees on one of four.
PIECES = ((0, 9), (9, 8), (17, 8), (25, 8))
HASHED_AT_ONCE = 1 << 18


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of the three-word shingles of a text, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(SHINGLE, len(words))
    spans = list(zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True))
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), HASHED_AT_ONCE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans[at : at + HASHED_AT_ONCE]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def _fingerprints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        values = np.array([fingerprint(text) for text in texts], dtype=np.uint64)
        yield pd.Series(values.view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint as a signed long. A null text has that of an empty one, zero."""
    return F.pandas_udf(_fingerprints, "long")(text)


def _masks() -> list[list[int]]:
    """By syndrome, what turns a word into each anchor within two bits of it.

    A word whose syndrome names position s becomes a code word by flipping s, or two
    positions i and j with i xor j = s.
    """
    flip = lambda position: 1 << (position - 1)
    by_syndrome = [[0]]
    for s in range(1, HALF + 1):
        pairs = [flip(i) | flip(i ^ s) for i in range(1, HALF + 1) if i < i ^ s]
        by_syndrome.append([flip(s), *pairs])
    return by_syndrome


def anchors(half: Column) -> Column:
    """The anchors within two bits of a 31-bit word."""
    syndrome = F.lit(0)
    for k in range(5):
        covered = sum(1 << (position - 1) for position in range(1, HALF + 1) if position >> k & 1)
        syndrome = syndrome + (F.bit_count(half.bitwiseAND(F.lit(covered).cast("long"))) % 2) * (1 << k)
    masks = F.array(*[F.array(*[F.lit(mask).cast("long") for mask in row]) for row in _masks()])
    return F.transform(F.get(masks, syndrome), lambda mask: half.bitwiseXOR(mask))


def spanning_links(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the distinct signed `members` within `distance` bits.

    Each member is compared with those not yet reached only, so that dense groups are cheap.
    """
    links, rest = [], members.view(np.uint64)
    while len(rest):
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= distance
            reached, rest = rest[near], rest[~near]
            links += [(root, member) for member in reached]
            front.extend(reached)
    return links


def _compare(limit: int | None, distance: int):
    """Reads (key, fingerprint) in order of key. Yields links, or, beyond `limit`, the members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, handed_on = None, [], False

        def rows(kind: int, key: int, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
            columns = [np.full(len(left), kind, np.int8), np.full(len(left), key, np.int64), left, right]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int8(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["kind", "key", "a", "b"],
            )

        def passed_on(members: np.ndarray) -> pa.RecordBatch:
            return rows(1, key, members, members)

        def finish() -> Iterator[pa.RecordBatch]:
            if key is None or handed_on:
                return
            links = spanning_links(np.unique(np.concatenate(held)), distance)
            if links:
                a, b = np.array(links, dtype=np.uint64).view(np.int64).T
                yield rows(0, key, a, b)

        for batch in batches:
            keys = batch.column(0).to_numpy()
            values = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(keys)) + 1
            for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                if begin == end:
                    continue
                if keys[begin] != key:
                    if len(held) > 1 or (held and len(held[0]) > 1) or handed_on:
                        yield from finish()
                    key, held, handed_on = int(keys[begin]), [], False
                piece = values[begin:end]
                if handed_on:
                    yield passed_on(piece)
                    continue
                held.append(piece)
                if limit is not None and sum(map(len, held)) > limit:
                    yield passed_on(np.concatenate(held))
                    held, handed_on = [], True
        if held or handed_on:
            yield from finish()

    return run


def _compared(keyed: DataFrame, limit: int | None, distance: int, name: str) -> DataFrame:
    tasks = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.select("key", "fingerprint").repartition(tasks, "key").sortWithinPartitions("key")
    return stored(dealt.mapInArrow(_compare(limit, distance), "kind tinyint, key long, a long, b long"), name)


def links(distinct: DataFrame, distance: int = DISTANCE, limit: int = ANCHOR_MEMBERS) -> DataFrame:
    """`a, b`: links within `distance` bits that connect all that is connected, of distinct fingerprints."""
    if not 0 <= distance <= 3:
        raise ValueError("the anchors cover differences of up to three bits")
    halves = F.array(*[F.shiftrightunsigned("fingerprint", side * HALF).bitwiseAND(F.lit((1 << HALF) - 1)) for side in (0, 1)])
    sides = distinct.select("fingerprint", F.posexplode(halves).alias("side", "half"))
    keys = F.transform(anchors(F.col("half")), lambda anchor: anchor * 2 + F.col("side"))
    keyed = sides.select("fingerprint", F.explode(keys).alias("key"))
    first = _compared(keyed, limit, distance, "simhash-links")
    found = first.filter("kind = 0").select("a", "b")
    crowded = first.filter("kind = 1").select("key", F.col("a").alias("fingerprint"))
    if crowded.isEmpty():
        return found
    # The 33 bits outside the half that the anchor stands for, low bits first.
    upper = F.shiftrightunsigned("fingerprint", HALF)
    lower = F.col("fingerprint").bitwiseAND(F.lit((1 << HALF) - 1)).bitwiseOR(
        F.shiftleft(F.shiftrightunsigned("fingerprint", 2 * HALF), HALF)
    )
    other = F.when(F.col("key") % 2 == 0, upper).otherwise(lower)
    pieces = F.array(
        *[
            F.shiftrightunsigned(other, at).bitwiseAND(F.lit((1 << width) - 1)) * len(PIECES) + number
            for number, (at, width) in enumerate(PIECES)
        ]
    )
    dealt = crowded.select("fingerprint", F.explode(F.transform(pieces, lambda piece: F.xxhash64("key", piece))).alias("key"))
    return found.union(_compared(dealt, None, distance, "simhash-crowded").select("a", "b"))


def _checkpointed(frame: DataFrame) -> DataFrame:
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """`node, root` of every node of `a, b` edges: the smallest node that it reaches.

    Each round takes the smallest root among neighbours, combined before the shuffle, and
    then the root's root, so rounds grow with the logarithm of the longest path.
    """
    both = _checkpointed(edges.union(edges.select("b", "a")).distinct().toDF("a", "b"))
    roots = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
    roots = _checkpointed(roots)
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node"))
        least = near.agg(F.min("root").alias("near"))
        step = roots.join(least, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = roots.select(F.col("node").alias("via"), F.col("root").alias("beyond"))
        after = step.join(jump, "via").select("node", "old", F.least("via", "beyond").alias("root"))
        after = _checkpointed(after)
        if after.filter("old <> root").isEmpty():
            return after.select("node", "root")
        roots = after.select("node", "root")


def classes(prints: DataFrame, distance: int = DISTANCE, limit: int = ANCHOR_MEMBERS) -> DataFrame:
    """`fingerprint, component_id, root` of the distinct fingerprints of `doc_id, fingerprint`."""
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    linked = components(links(distinct.select("fingerprint"), distance, limit))
    rooted = distinct.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fingerprint", "component_id", "root")


def deduplicate(docs: DataFrame, distance: int = DISTANCE, limit: int = ANCHOR_MEMBERS) -> DataFrame:
    """`doc_id, fingerprint` (16 hex digits) and `component_id` of every row.

    `component_id` is the smallest doc_id that is reached over links of at most `distance`
    bits; null doc_ids are passed over, and a class of null doc_ids only has a null id.
    Null, empty and wordless texts share the fingerprint zero. Repeated rows give repeated
    rows; other columns are ignored.
    """
    prints = stored(docs.select("doc_id", fingerprints(F.col("text")).alias("fingerprint")), "simhash-prints")
    joined = prints.join(classes(prints, distance, limit), "fingerprint")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def one_per_class(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs` with the smallest doc_id of their class, one row per class, with all their columns.

    Of rows that share it, that with the smallest fingerprint stays, then that with the smallest text; of rows
    equal in both, any.
    """
    # The rows travel as one column, so that no name of theirs meets one of this module.
    packed = docs.select(F.struct("*").alias("row"), fingerprints(F.col("text")).alias("fingerprint"))
    marked = stored(packed, "simhash-docs")
    kept = classes(marked.select(F.col("row.doc_id").alias("doc_id"), "fingerprint"), distance)
    first = marked.join(kept, "fingerprint").filter(F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    # Rows that repeat the smallest doc_id are few: combined before the shuffle, by class.
    least = F.min_by("row", F.struct("fingerprint", F.col("row.text"))).alias("row")
    return first.groupBy("root").agg(least).select("row.*")
