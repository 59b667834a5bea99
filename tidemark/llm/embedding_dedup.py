"""Near-duplicate embeddings by an inverted multi-index.

The two halves of the unit vectors have codebooks of their own, fitted on a bounded sample. A cell
of the index is a pair of words, one of each half, so K words a half make K * K cells. A vector's
multi-sequence traversal visits cells in the order of its summed squared distance to both words
and ends at a slack above the nearest one. Every vector is posted to each cell it visits, and
vectors that meet in a cell are verified there, by cosines in double precision. The slack is the
smallest that makes `recall` of sampled pairs meet which are as far apart as a link allows.

K follows the number of vectors, so a cell holds about `CELL_VECTORS` whatever that number is.
Equal vectors are one row with a weight in all that is compared. A cell with more than `CELL_ROWS`
rows is dealt into parts, and every pair of parts is compared in a task of its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import once, stored
from tidemark.llm.simhash import components

COSINE = 0.9
RECALL = 0.95
CELL_VECTORS = 512
CELL_ROWS = 4096
# Bounds of what the driver fits on: vectors (and their components) for the codebooks, pairs for the slack.
SAMPLE_VECTORS = 32_768
SAMPLE_COMPONENTS = 1 << 23
SAMPLE_PAIRS = 2_048
MOST_WORDS = 2_048
# Words of each half, from the nearest on, that a traversal combines.
NEAREST_WORDS = 32
ROUNDS = 10


def comparable(vector: Column) -> Column:
    """Whether the vector has a direction: some component is not zero and all are finite numbers."""
    size = F.lit(float("inf"))
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == size))
    return F.coalesce(~broken & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of length one in double precision, filled up with zeros to `width`."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.zeros((len(lists), width))
    rows[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    # Scaled first, so that no square overflows or vanishes.
    rows /= np.abs(rows).max(axis=1, initial=0, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    squares = np.square(rows).sum(axis=1)[:, None] + np.square(words).sum(axis=1)
    return squares - 2 * rows @ words.T


def _words(rows: np.ndarray, count: int, dice: np.random.Generator) -> np.ndarray:
    """`count` centres of `rows` after some rounds of Lloyd's method; centres of nothing stay."""
    words = rows[dice.choice(len(rows), count, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([_distances(part, words).argmin(axis=1) for part in np.array_split(rows, 1 + len(rows) // 4096)])
        members = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, rows)
        words = np.where(members[:, None] > 0, sums / np.maximum(members, 1)[:, None], words)
    return words


class MultiIndex:
    """Two codebooks, and how far beyond its nearest cell a vector is posted."""

    def __init__(self, sample: np.ndarray, vectors: int, cosine: float, recall: float, cell_vectors: int):
        dice = np.random.default_rng(0)
        self.half = sample.shape[1] // 2
        words = int(np.ceil(np.sqrt(max(vectors, 1) / cell_vectors)))
        words = max(1, min(words, MOST_WORDS, len(sample)))
        self.books = [_words(part, words, dice) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.slack = self._slack(sample[dice.permutation(len(sample))[:SAMPLE_PAIRS]], cosine, recall, dice)

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(rows[:, : self.half], self.books[0]), _distances(rows[:, self.half :], self.books[1])

    def _near(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By row: the nearest words of each half, and how far each pair of them is beyond the nearest pair."""
        count = min(NEAREST_WORDS, len(self.books[0]))
        halves = self.distances(rows)
        near = [np.argpartition(d, count - 1, axis=1)[:, :count] for d in halves]
        beyond = [np.take_along_axis(d, n, axis=1) for d, n in zip(halves, near, strict=True)]
        beyond = [d - d.min(axis=1, keepdims=True) for d in beyond]
        return near[0], near[1], beyond[0][:, :, None] + beyond[1][:, None, :]

    def _slack(self, rows: np.ndarray, cosine: float, recall: float, dice: np.random.Generator) -> float:
        """Each sampled vector and one turned away from it by the angle of `cosine` in a random
        direction meet at the smallest over cells of the greater of both excesses."""
        away = dice.normal(size=rows.shape)
        away -= (away * rows).sum(axis=1, keepdims=True) * rows
        length = np.linalg.norm(away, axis=1, keepdims=True)
        turned = cosine * rows + np.sqrt(1 - cosine**2) * away / np.where(length > 0, length, 1)
        meets = []
        for part, other in zip(np.array_split(rows, 16), np.array_split(turned, 16), strict=True):
            if not len(part):
                continue
            first, second, excess = self._near(part)
            d = self.distances(other)
            least = d[0].min(axis=1) + d[1].min(axis=1)
            theirs = np.take_along_axis(d[0], first, 1)[:, :, None] + np.take_along_axis(d[1], second, 1)[:, None, :]
            meets.append(np.maximum(excess, theirs - least[:, None, None]).min(axis=(1, 2)))
        return float(np.quantile(np.concatenate(meets), recall))

    def visits(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`row, cell` of every visit, cells ascending within a row."""
        row, cell = [], []
        for at in range(0, len(rows), 1024):
            first, second, excess = self._near(rows[at : at + 1024])
            r, i, j = np.nonzero(excess <= self.slack)
            row.append(r + at)
            cell.append(first[r, i].astype(np.int64) * len(self.books[1]) + second[r, j])
        row, cell = np.concatenate(row), np.concatenate(cell)
        order = np.lexsort((cell, row))
        return row[order], cell[order]


def _merged(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and how many rows each stands for."""
    return np.unique(keys, return_index=True, return_counts=True)


def _post(index: MultiIndex, width: int):
    """From `key, vector` rows to one row per distinct vector of a batch and cell it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, places, weights = _merged(batch.column(0).to_numpy())
            vectors = batch.column(1).take(pa.array(places))
            row, cell = index.visits(unit_rows(vectors, width))
            starts = np.searchsorted(row, np.arange(len(keys) + 1))
            cells = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(cell, pa.int64()))
            taken = pa.array(row)
            columns = [
                pa.array(cell, pa.int64()),
                pa.array(keys, pa.int64()).take(taken),
                pa.array(weights, pa.int64()).take(taken),
                cells.take(taken),
                vectors.take(taken),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "key", "weight", "cells", "vector"])

    return run


def _cell_counts(index: MultiIndex, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, places, _ = _merged(batch.column(0).to_numpy())
            _, cell = index.visits(unit_rows(batch.column(1).take(pa.array(places)), width))
            cells, counts = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts)], names=["cell", "rows"])

    return run


def _links(units: np.ndarray, cosine: float, between: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of `between` with at least `cosine`; with itself, each pair once.

    Single precision decides what lies beyond its error of the threshold, double precision the rest.
    """
    left, right = between
    same = left is right
    single = units.astype(np.float32)
    error = max(1e-5, units.shape[1] * 2e-7)
    for at in range(0, len(left), 512):
        part = left[at : at + 512]
        found = single[part] @ single[right].T
        i, j = np.nonzero(found >= cosine - error)
        sure = found[i, j] >= cosine + error
        if same:
            forward = j > i + at
            i, j, sure = i[forward], j[forward], sure[forward]
        for begin in range(0, len(i), 1 << 17):
            a, b, clear = part[i[begin : begin + (1 << 17)]], right[j[begin : begin + (1 << 17)]], sure[begin : begin + (1 << 17)]
            linked = clear.copy()
            linked[~clear] = np.einsum("ij,ij->i", units[a[~clear]], units[b[~clear]]) >= cosine
            if linked.any():
                yield a[linked], b[linked]


def _roots(count: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest row that each row reaches over `pairs`."""
    roots = np.arange(count)
    while True:
        before = roots.copy()
        for a, b in pairs:
            low = np.minimum(roots[a], roots[b])
            np.minimum.at(roots, a, low)
            np.minimum.at(roots, b, low)
        roots = roots[roots]
        if (roots == before).all():
            return roots


def _verify(cosine: float, width: int):
    """Links among the rows of one cell, or between two parts of it: by row with links, their
    number (weighted, each pair in the first cell both visit only) and a row it reaches."""
    fields = pa.schema([("key", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(cell: tuple, rows: pa.Table) -> pa.Table:
        here, a, b = (value.as_py() for value in cell)
        all_keys = rows.column("key").to_numpy()
        keys, places, _ = _merged(all_keys)
        weights = np.bincount(np.searchsorted(keys, all_keys), rows.column("weight").to_numpy()).astype(np.int64)
        rows = rows.take(pa.array(places))
        units = unit_rows(rows.column("vector"), width)
        cells = rows.column("cells").combine_chunks()
        sizes = cells.value_lengths().to_numpy()
        visited = np.full((len(keys), sizes.max()), -1, np.int64)
        visited[np.arange(sizes.max()) < sizes[:, None]] = cells.flatten().to_numpy()
        # Earlier cells only: a pair that shares one was counted there.
        visited = np.where(visited < here, visited, -1)
        visited = visited[:, : max(1, int((visited >= 0).sum(axis=1).max()))]
        part = rows.column("part").to_numpy()
        sides = (np.flatnonzero(part == a), np.flatnonzero(part == b)) if a != b else (np.arange(len(keys)),) * 2
        links, pairs = np.zeros(len(keys), np.int64), []
        for i, j in _links(units, cosine, sides):
            shared = visited[i][:, :, None] == visited[j][:, None, :]
            new = ~(shared & (visited[i] >= 0)[:, :, None]).any(axis=(1, 2))
            np.add.at(links, i[new], weights[j[new]])
            np.add.at(links, j[new], weights[i[new]])
            pairs.append((i[new], j[new]))
        roots = _roots(len(keys), pairs)
        linked = links > 0
        return pa.Table.from_arrays([keys[linked], links[linked], keys[roots[linked]]], schema=fields)

    return run


def fit(vectors: DataFrame, keys: DataFrame, count: int, width: int, cosine: float, recall: float, cell_vectors: int) -> MultiIndex:
    """The index for `key, vector` rows, from a bounded number of them: those of the smallest hashes
    among the distinct `keys`, so that copies weigh no more than others."""
    size = max(1, min(SAMPLE_VECTORS, SAMPLE_COMPONENTS // max(width, 1)))
    chosen = keys.orderBy(F.xxhash64("key", F.lit("sample"))).limit(size)
    sample = vectors.join(F.broadcast(chosen), "key", "left_semi").dropDuplicates(["key"]).orderBy("key").toArrow()
    return MultiIndex(unit_rows(sample.column("vector"), width), count, cosine, recall, cell_vectors)


def links(
    vectors: DataFrame,
    keys: DataFrame,
    count: int,
    width: int,
    cosine: float = COSINE,
    recall: float = RECALL,
    cell_vectors: int = CELL_VECTORS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """`key, links, root` of linked vectors, some rows for each: the links add up.

    `vectors` are `key, vector` rows, `keys` their `count` distinct keys.
    """
    index = fit(vectors, keys, count, width, cosine, recall, cell_vectors)
    kind = vectors.schema["vector"].dataType.simpleString()
    dealt = vectors.select("key", "vector")
    counted = dealt.mapInArrow(_cell_counts(index, width), "cell long, rows long")
    crowded = counted.groupBy("cell").agg(F.sum("rows").alias("rows")).where(F.col("rows") > cell_rows)
    crowded = stored(crowded.select("cell", F.ceil(F.col("rows") / cell_rows).cast("int").alias("parts")), "crowded-cells")
    posts = dealt.mapInArrow(_post(index, width), f"cell long, key long, weight long, cells array<long>, vector {kind}")
    placed = posts.join(crowded, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = placed.select("*", other.alias("other")).drop("parts").withColumns(
        {"a": F.least("part", "other"), "b": F.greatest("part", "other")}
    )
    tested = pairs.drop("other").groupBy("cell", "a", "b").applyInArrow(_verify(cosine, width), "key long, links long, root long")
    return stored(tested, "embedding-links")


def deduplicate(
    vectors: DataFrame,
    cosine: float = COSINE,
    recall: float = RECALL,
    cell_vectors: int = CELL_VECTORS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` of every row of `vec_id, embedding`.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with
    nothing and are kept. A vector shorter than the longest counts as filled up with zeros.
    Repeated rows are vectors of their own and link with one another. `component_id` passes over
    null ids, and is null for a class without any other; `kept` compares null-safe. Other
    columns are ignored.
    """
    vector = F.col("embedding")
    marked = once(
        vectors.select("vec_id", "embedding"),
        key=F.when(comparable(vector), F.xxhash64(vector)),
    )
    size = F.when(F.col("key").isNotNull(), F.size("embedding")).alias("size")
    coded = stored(marked.select("vec_id", "key", size), "embedding-keys")
    copies = coded.where("key IS NOT NULL").groupBy("key")
    distinct = stored(
        copies.agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.max("size").alias("width")), "embedding-copies"
    )
    total = distinct.agg(F.count("key").alias("vectors"), F.max("width").alias("width")).first()
    alone = coded.where("key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not total["vectors"]:
        return alone
    usable = marked.where("key IS NOT NULL").select("key", F.col("embedding").alias("vector"))
    found = links(usable, distinct.select("key"), total["vectors"], total["width"], cosine, recall, cell_vectors, cell_rows)
    degrees = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    classes = (
        distinct.drop("width")
        .join(degrees, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    smallest = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    known = classes.join(smallest, "root").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    rows = coded.where("key IS NOT NULL").join(known, "key")
    linked = rows.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
    return linked.unionByName(alone)
