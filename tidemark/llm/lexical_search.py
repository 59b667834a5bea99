"""Ranked lexical search by dual trees.

An item is a vector of term weights and a document one of saturated term counts; a score is their
inner product. Items, and the documents of a batch, stand in hierarchies whose nodes hold the
coordinate maxima of what is below. The product of two nodes' maxima bounds every score between
them. A pair of nodes whose bound is below the weakest kth score of the node's items is left with
all that is below it; what remains is opened level by level and scored exactly at the bottom.

Texts are read once per block of items: a document becomes its number of terms and its counts of
those terms that some item of the block has. First bounds come from a bounded set of documents;
within a task they rise with every batch.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BEST = 20
FANOUT = 4
# Text of items that are searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
# Entries of a dense matrix of items, or of documents, and terms.
DENSE = 1 << 21
# Documents, about, whose scores give the first bounds.
FIRST_DOCUMENTS = 8_192
# Below this, a sum of whole numbers in double precision is exact.
EXACT = 1 << 53

_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters and of all other characters, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split()


class Group:
    """Items whose dense matrix of weights is small, and the levels of their hierarchy."""

    def __init__(self, items: list[int], columns: np.ndarray, weights: np.ndarray):
        self.items = np.array(items)
        self.columns = columns
        exact = int(weights.sum(axis=1).max(initial=0)) * 1_000_000 < EXACT
        self.kind = np.float64 if exact else np.int64
        self.levels = _levels(weights.astype(self.kind))
        # By level and parent: the columns in which any child has a weight.
        self.active = [[np.flatnonzero(node) for node in above] for above in [*self.levels[1:], self.levels[-1]]]


def _levels(rows: np.ndarray) -> list[np.ndarray]:
    """The rows, then the maxima of `FANOUT` consecutive nodes at a time, up to a single one."""
    levels = [rows]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), FANOUT), axis=0))
    return levels


class Items:
    """The items of a block: their terms, and, once statistics are known, their weights."""

    def __init__(self, rows: list[tuple[int, object, str | None]]):
        self.counts = [Counter(terms_of(text)) for _, _, text in rows]
        self.rows = [row for row, _, _ in rows]
        self.ids = [item_id for _, item_id, _ in rows]
        self.places = {term: place for place, term in enumerate(sorted({t for c in self.counts for t in c}))}

    def weigh(self, documents: int, frequency: dict[int, int], dense: int) -> list[Group]:
        """Groups of items that have terms in common, with w per term and repeat."""
        weight = {}
        for term, place in self.places.items():
            weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(place, 0) + 1)))
        lead = [min(c, key=lambda t: (frequency.get(self.places[t], 0), t), default=b"") for c in self.counts]
        groups, held, columns = [], [], set()
        for item in sorted((i for i, c in enumerate(self.counts) if c), key=lambda i: (lead[i], i)):
            more = columns | {self.places[t] for t in self.counts[item]}
            if held and (len(held) + 1) * len(more) > dense:
                groups.append(self._group(held, columns, weight))
                held, more = [], {self.places[t] for t in self.counts[item]}
            held, columns = [*held, item], more
        if held:
            groups.append(self._group(held, columns, weight))
        return groups

    def _group(self, items: list[int], columns: set[int], weight: dict[bytes, int]) -> Group:
        ordered = np.array(sorted(columns))
        weights = np.zeros((len(items), len(ordered)), np.int64)
        for row, item in enumerate(items):
            terms = self.counts[item]
            at = np.searchsorted(ordered, [self.places[t] for t in terms])
            weights[row, at] = [count * weight[t] for t, count in terms.items()]
        return Group(items, ordered, weights)


def _vectors(places: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, offsets, terms, counts = [], [0], [], []
            for text in batch.column(1):
                found = Counter(terms_of(text.as_py()))
                lengths.append(found.total())
                for term in found.keys() & places.keys():
                    terms.append(places[term])
                    counts.append(found[term])
                offsets.append(len(terms))
            ends = pa.array(offsets, pa.int32())
            columns = [
                batch.column(0),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "length", "terms", "counts"])

    return run


class Search:
    """The best documents of each item so far, of the batches one task has seen."""

    def __init__(self, groups: list[Group], weakest: np.ndarray, best: int, dense: int):
        self.groups, self.best, self.dense = groups, best, dense
        self.weakest = weakest.copy()
        self.scores = [np.zeros(0, np.int64) for _ in weakest]
        self.ids = [np.zeros(0, np.int64) for _ in weakest]
        self.scored = 0

    def add(self, ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """Looks at a batch of documents: document d has `values[starts[d]:starts[d + 1]]` at `terms`."""
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        for group in self.groups:
            column = np.searchsorted(group.columns, terms)
            column[column == len(group.columns)] = 0
            known = group.columns[column] == terms
            rows, cols, vals = owner[known], column[known], values[known]
            met = np.unique(rows)
            if not len(met):
                continue
            # Documents with the same heaviest term side by side, so that nodes have few terms.
            heaviest = group.levels[-1][0][cols] * vals
            order = np.lexsort((-heaviest, rows))
            lead = cols[order][np.searchsorted(rows[order], met)]
            met = met[np.lexsort((met, lead))]
            rank = np.full(len(ids), -1)
            rank[met] = np.arange(len(met))
            rows = rank[rows]
            order = np.argsort(rows, kind="stable")
            rows, cols, vals = rows[order], cols[order], vals[order]
            size = max(1, self.dense // len(group.columns))
            for at in range(0, len(met), size):
                a, b = np.searchsorted(rows, [at, at + size])
                count = min(size, len(met) - at)
                matrix = np.zeros((count, len(group.columns)), group.kind)
                matrix[rows[a:b] - at, cols[a:b]] = vals[a:b]
                self._descend(group, matrix, ids[met[at : at + count]])

    def _descend(self, group: Group, matrix: np.ndarray, ids: np.ndarray) -> None:
        documents = _levels(matrix)
        weakest = [self.weakest[group.items]]
        for _ in group.levels[1:]:
            weakest.append(np.minimum.reduceat(weakest[-1], np.arange(0, len(weakest[-1]), FANOUT)))
        i_level, d_level = len(group.levels) - 1, len(documents) - 1
        items, docs = np.zeros(1, int), np.zeros(1, int)
        while len(items):
            bound = _bounds(group.levels[i_level], group.active[i_level], documents[d_level], items, docs)
            open_ = (bound >= weakest[i_level][items]) & (bound > 0)
            items, docs, bound = items[open_], docs[open_], bound[open_]
            if i_level == d_level == 0:
                self.scored += len(open_)
                self._keep(group.items[items], ids[docs], bound.astype(np.int64))
                return
            # The taller hierarchy is opened, both when they are level.
            open_items, open_docs = i_level >= d_level, d_level >= i_level
            if open_docs:
                d_level -= 1
                items, docs = _opened(docs, items, len(documents[d_level]))
            if open_items:
                i_level -= 1
                docs, items = _opened(items, docs, len(group.levels[i_level]))

    def _keep(self, items: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        order = np.argsort(items, kind="stable")
        items, ids, scores = items[order], ids[order], scores[order]
        which, begins, counts = np.unique(items, return_index=True, return_counts=True)
        for item, begin, end in zip(which, begins, begins + counts, strict=True):
            score = np.concatenate([self.scores[item], scores[begin:end]])
            doc = np.concatenate([self.ids[item], ids[begin:end]])
            first = np.lexsort((doc, -score))[: self.best]
            self.scores[item], self.ids[item] = score[first], doc[first]
            if len(first) == self.best:
                self.weakest[item] = max(self.weakest[item], score[first[-1]])


def _bounds(level: np.ndarray, active: list[np.ndarray], documents: np.ndarray, items: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The product of each pair of nodes, worked out for the children of one item node at a time."""
    parent = items // FANOUT
    order = np.argsort(parent, kind="stable")
    which, begins, counts = np.unique(parent[order], return_index=True, return_counts=True)
    bounds = np.zeros(len(items), level.dtype)
    for node, begin, end in zip(which, begins, begins + counts, strict=True):
        pairs = order[begin:end]
        left, i_at = np.unique(items[pairs], return_inverse=True)
        right, d_at = np.unique(docs[pairs], return_inverse=True)
        columns = active[node]
        bounds[pairs] = (level[np.ix_(left, columns)] @ documents[np.ix_(right, columns)].T)[i_at, d_at]
    return bounds


def _opened(nodes: np.ndarray, partners: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once per child of its node, of a level with `count` nodes: partners, then children."""
    children = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
    there = children < count
    return np.repeat(partners, FANOUT)[there], children[there]


# Stands for a null doc_id, which comes after all others.
NO_ID = np.iinfo(np.int64).max


def _best(groups: list[Group], weakest: np.ndarray, best: int, documents: int, terms: int, dense: int):
    """From vectors to the best rows of a task: `place` of the item, `doc_id`, `no_id` and `score`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not groups:
            return
        search = Search(groups, weakest, best, dense)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            lists = batch.column(2)
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            counts = batch.column(3).flatten().to_numpy().astype(np.int64)
            length = np.repeat(batch.column(1).to_numpy(), np.diff(starts))
            measure = 100 - 25 + (25 * length * documents) // terms
            values = (1_000_000_000 * counts) // (1000 * counts + 12 * measure)
            search.add(ids, starts, lists.flatten().to_numpy(), values)
        place = np.repeat(np.arange(len(weakest)), [len(s) for s in search.scores])
        found, scores = np.concatenate(search.ids), np.concatenate(search.scores)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(found), pa.array(scores)], names=["place", "doc_id", "score"]
        )

    return run


def _search_block(docs: DataFrame, items: Items, best: int, dense: int) -> DataFrame:
    spark = docs.sparkSession
    schema = "doc_id long, length long, terms array<int>, counts array<int>"
    vectors = stored(docs.mapInArrow(_vectors(items.places), schema), "search-vectors")
    total = vectors.agg(F.count_if(F.col("length") > 0).alias("documents"), F.sum("length").alias("terms")).first()
    documents, terms = total["documents"] or 0, total["terms"] or 0
    holding = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("documents"))
    # At most one row per term of the block.
    groups = items.weigh(documents, {r["term"]: r["documents"] for r in holding.collect()}, dense)
    none = np.zeros(len(items.rows), np.int64)
    rows = "place int, doc_id long, score long"
    ranked = W.partitionBy("place").orderBy(F.desc("score"), "doc_id")
    nth = F.row_number().over(ranked)
    usable = vectors.where(F.size("terms") > 0)

    def found(some: DataFrame, weakest: np.ndarray) -> DataFrame:
        # Not all scores above zero: bounds start at one.
        hits = some.mapInArrow(_best(groups, np.maximum(weakest, 1), best, documents, terms, dense), rows)
        return hits.withColumn("rank", nth).where(F.col("rank") <= best)

    weakest = none.copy()
    # Any documents do for bounds that hold; which ones these are does not show in the result.
    first = usable.sample(min(1.0, FIRST_DOCUMENTS / max(documents, 1)), seed=0)
    for row in found(first, none).where(F.col("rank") == best).collect():
        weakest[row["place"]] = row["score"]
    names = spark.createDataFrame(
        [(place, row, item_id) for place, (row, item_id) in enumerate(zip(items.rows, items.ids, strict=True))],
        "place int, row long, item_id long",
    )
    hits = found(usable, weakest).join(F.broadcast(names), "place")
    doc_id = F.when(F.col("doc_id") != F.lit(int(NO_ID)), F.col("doc_id")).alias("doc_id")
    return hits.select("item_id", F.col("rank").cast("int").alias("rank"), doc_id, "score")


def rank(
    docs: DataFrame, items: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES, dense: int = DENSE
) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `best` documents of each item with a score above zero.

    Null and empty texts have no terms: such documents are found by nothing and not counted,
    such items give no rows. Equal scores are ranked by ascending doc_id, null last; equal in both,
    rows are alike. Repeated items are each answered. Other columns are ignored.
    """
    numbered = stored(items.select("item_id", "text", F.monotonically_increasing_id().alias("row")), "search-items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    answers = None
    for block in range(blocks):
        chosen = numbered.where(F.pmod("row", F.lit(blocks)) == block).orderBy("row")
        rows = [(r["row"], r["item_id"], r["text"]) for r in chosen.collect()]
        answer = _search_block(docs.select("doc_id", "text"), Items(rows), best, dense)
        answers = answer if answers is None else answers.unionByName(answer)
    return answers
