"""LM scoring by a weighted backoff automaton.

The n-grams of the training texts, smoothed with a Dirichlet prior, are the arcs of an
automaton: a state is a context, a seen continuation has an arc with its log-probability, and
a failure arc with the context's backoff weight leads to the state without its oldest word. The
root has an arc for every word. A text is scored in one pass from left to right that carries the
state and adds up weights.

No task holds the whole model. Texts are dealt into chunks. Each chunk asks for the
n-grams it meets, once each, with its own training counts; requests are dealt by hash of the
n-gram, summed over all chunks, and the sums go back to the chunks that asked. A chunk then
builds the part of the automaton that its texts can reach. Frequent n-grams cost one entry
per chunk, and a hash range holds about as many entries as any other.
"""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 2
# Weight of the shorter context in observations, for contexts of one word and longer.
PRIOR = 100.0
HELD_OUT, FOLDS = 2, 7
CHUNK_BYTES = 4_000_000
SHARD_BYTES = 12_000_000
# Texts that take a step together, at least.
TOGETHER = 16
# Neither can be a word: both hold white space.
BEGIN, END = b" ", b"\n"
MIXER, FINISHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def words_in(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered; bytes split on ASCII white space only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


class Grams:
    """The n-grams of a chunk of texts.

    `tokens` strings the texts together, each between BEGIN and END. `place[k]` gives each
    position the number of the (k+1)-gram that ends there among the chunk's distinct n-grams,
    -1 where a text has not begun long enough before.
    """

    def __init__(self, texts: list[str | None], order: int):
        vocabulary: dict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        number = vocabulary.__getitem__
        begin, end = number(BEGIN), number(END)
        pieces, sizes = [], []
        for text in texts:
            words = words_in(text)
            pieces.append(np.fromiter(map(number, words), np.int32, len(words)))
            pieces.append(np.array([end, begin], np.int32))
            sizes.append(len(words) + 1)
        self.tokens = np.concatenate([np.array([begin], np.int32), *pieces])[:-1] if texts else np.zeros(0, np.int32)
        self.sizes = np.array(sizes, np.int64)
        self.is_begin = self.tokens == begin
        self.text_of = np.cumsum(self.is_begin) - 1
        hashes = np.fromiter((xxhash.xxh64_intdigest(word, 7) for word in vocabulary), np.uint64, len(vocabulary))
        depth = np.arange(len(self.tokens)) - np.flatnonzero(self.is_begin)[self.text_of] if texts else self.tokens
        last = hashes[self.tokens]
        grams, valid = [last], [np.ones(len(last), bool)]
        for k in range(1, order):
            longer = np.zeros_like(last)
            mixed = (grams[-1][:-1] * MIXER) ^ (grams[-1][:-1] >> np.uint64(29))
            longer[1:] = (mixed + last[1:]) * FINISHER
            grams.append(longer ^ (longer >> np.uint64(32)))
            valid.append(depth >= k)
        flat = np.concatenate([gram[ok] for gram, ok in zip(grams, valid, strict=True)])
        self.distinct, number_of = np.unique(flat, return_inverse=True)
        self.place, at = [], 0
        for ok in valid:
            places = np.full(len(last), -1, np.int64)
            places[ok] = number_of[at : at + ok.sum()]
            at += ok.sum()
            self.place.append(places)

    def counts(self, trains: np.ndarray) -> np.ndarray:
        """How often each distinct n-gram ends in a text that trains."""
        total = np.zeros(len(self.distinct), np.int64)
        chosen = trains[self.text_of] if len(self.text_of) else np.zeros(0, bool)
        for places in self.place:
            total += np.bincount(places[chosen & (places >= 0)], minlength=len(total))
        return total

    def base(self, counts: np.ndarray, n_tokens: int, n_types: int) -> tuple[np.ndarray, np.ndarray]:
        """Known tokens and base score of each text, from the corpus counts of its words."""
        here = np.flatnonzero(~self.is_begin)
        count = counts[self.place[0][here]]
        total = lambda values: np.bincount(self.text_of[here], values, minlength=len(self.sizes))
        return total(count > 0).astype(np.int64), total(np.log10((count + 1) / (n_tokens + n_types + 1)))


class Automaton:
    """The states, arcs and failure arcs that the texts of a chunk can reach.

    State 0 is the root; an n-gram that trained and can be a context is the state of its number, plus
    one. A state and a word make an n-gram, whose number is that of the arc: `weight` has its weight, or
    nan if there is no such arc, and `target` the state it leads to. A state has a `depth`, the words of
    its context, a failure weight and the state it fails to.
    """

    def __init__(self, grams: Grams, counts: np.ndarray, n_tokens: int, n_types: int, prior: float):
        order, n = len(grams.place), len(grams.distinct)
        trained = counts > 0
        state_of = np.where(trained, np.arange(n) + 1, 0)
        weight, target = np.full(n, np.nan), np.zeros(n, np.int64)
        depth, failure, failure_weight = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.zeros(n + 1)
        position = np.zeros(n, np.int64)
        for k, places in enumerate(grams.place):
            # Any position of an n-gram of this length tells its context and its suffix.
            here = np.flatnonzero(places >= 0)
            position[places[here]] = here
            gram = places[here] if k == 0 else places[here[trained[places[here]]]]
            gram = np.flatnonzero(np.bincount(gram, minlength=n))
            at = position[gram]
            suffix = grams.place[k - 1][at] if k else None
            if k == 0:
                weight[gram] = np.log10((counts[gram] + 1) / (n_tokens + n_types + 1))
            else:
                held = counts[grams.place[k - 1][at - 1]]
                weight[gram] = np.log10((counts[gram] + prior * 10.0 ** weight[suffix]) / (held + prior))
            if k + 1 < order:
                target[gram] = state_of[gram]
                known = gram[trained[gram]]
                depth[known + 1] = k + 1
                failure[known + 1] = state_of[suffix[trained[gram]]] if k else 0
                failure_weight[known + 1] = np.log10(prior / (counts[known] + prior))
            elif k:
                target[gram] = state_of[suffix]
        self.weight, self.target = weight, target
        self.depth, self.failure, self.failure_weight = depth, failure, failure_weight
        begins = np.flatnonzero(grams.is_begin)
        self.start = int(state_of[grams.place[0][begins[0]]]) if order > 1 and len(begins) else 0

    def scores(self, grams: Grams) -> np.ndarray:
        """The log10 probability of each text, in one pass over its words and its end.

        All texts of the chunk take a step at a time, the longest first; the last few go on by themselves.
        """
        begins = np.flatnonzero(grams.is_begin)
        longest = np.argsort(-grams.sizes, kind="stable")
        ends = np.searchsorted(-grams.sizes[longest], -np.arange(int(grams.sizes.max(initial=0))), side="left")
        # By length, the n-grams that end with each word: one of them is the word in the state's context.
        ending = np.stack(grams.place) if len(begins) else np.zeros((1, 0), np.int64)
        state, total = np.full(len(longest), self.start), np.zeros(len(longest))
        step = 0
        while step < len(ends) and ends[step] >= TOGETHER:
            going = slice(0, ends[step])
            at, here = begins[longest[going]] + 1 + step, state[going]
            gram = ending[self.depth[here], at]
            weight = self.weight[gram]
            stuck = np.flatnonzero(np.isnan(weight))
            while len(stuck):
                total[stuck] += self.failure_weight[here[stuck]]
                here[stuck] = self.failure[here[stuck]]
                gram[stuck] = ending[self.depth[here[stuck]], at[stuck]]
                weight[stuck] = self.weight[gram[stuck]]
                stuck = stuck[np.isnan(weight[stuck])]
            total[going] += weight
            state[going] = self.target[gram]
            step += 1
        for n in range(ends[step] if step < len(ends) else 0):
            begin = begins[longest[n]]
            rest = ending[:, begin + 1 + step : begin + 1 + grams.sizes[longest[n]]]
            total[n] = self._alone(rest, int(state[n]), float(total[n]))
        out = np.zeros(len(longest))
        out[longest] = total
        return out

    def _alone(self, ending: np.ndarray, state: int, total: float) -> float:
        weight, target, depth = self.weight.item, self.target.item, self.depth.item
        failure, failure_weight = self.failure.item, self.failure_weight.item
        for grams in zip(*ending.tolist(), strict=True):
            gram = grams[depth(state)]
            arc = weight(gram)
            while arc != arc:
                total += failure_weight(state)
                state = failure(state)
                gram = grams[depth(state)]
                arc = weight(gram)
            total += arc
            state = target(gram)
        return total


def packed_hashes(ordered: np.ndarray) -> bytes:
    """Steps between sorted hashes, byte by byte of all: the upper bytes are zeros and compress away."""
    steps = np.diff(ordered, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_hashes(value: bytes) -> np.ndarray:
    steps = np.frombuffer(value, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.int64).tobytes())


def unpacked_counts(value: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value), np.int64)


def _shard_bounds(distinct: np.ndarray, bits: int) -> np.ndarray:
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate(([0], np.searchsorted(distinct, edges), [len(distinct)]))


def _requests(order: int, bits: int):
    schema = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        grams = Grams(table.column("text").to_pylist(), order)
        counts = grams.counts(~table.column("held_out").to_numpy(zero_copy_only=False))
        bounds = _shard_bounds(grams.distinct, bits)
        chunk = table.column("chunk")[0].as_py()
        shards = [(s, a, b) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
        return pa.table(
            [
                [chunk] * len(shards),
                [s for s, _, _ in shards],
                [packed_hashes(grams.distinct[a:b]) for _, a, b in shards],
                [packed_counts(counts[a:b]) for _, a, b in shards],
            ],
            schema=schema,
        )

    return run


def _sums(table: pa.Table) -> pa.Table:
    """Replaces each chunk's counts in a shard with the sums over all chunks."""
    grams = [unpacked_hashes(value) for value in table.column("grams").to_pylist()]
    counts = [unpacked_counts(value) for value in table.column("counts").to_pylist()]
    _, number = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(number, np.concatenate(counts)).astype(np.int64)
    sizes = np.cumsum([len(gram) for gram in grams])[:-1]
    answers = [packed_counts(total[part]) for part in np.split(number, sizes)]
    return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "counts": pa.array(answers, pa.binary())})


def _scores(order: int, prior: float, n_tokens: int, n_types: int):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        held_out = texts.column("held_out")
        grams = Grams(texts.column("text").to_pylist(), order)
        by_shard = sorted(zip(answers.column("shard").to_pylist(), answers.column("counts").to_pylist(), strict=True))
        counts = np.concatenate([unpacked_counts(value) for _, value in by_shard])
        known, base = grams.base(counts, n_tokens, n_types)
        score = Automaton(grams, counts, n_tokens, n_types, prior).scores(grams)
        return pa.table(
            {
                "doc_id": texts.column("doc_id"),
                "held_out": held_out,
                "n_tokens": pa.array(grams.sizes),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(known), n_tokens, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    return run


def _types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of training texts with their counts, summed over a task's texts a few MB at a time."""
    held: dict[bytes, int] = defaultdict(int)

    def handed_on() -> pa.RecordBatch:
        hashes = np.fromiter((xxhash.xxh64_intdigest(word, 7) for word in held), np.uint64, len(held))
        counts = np.fromiter(held.values(), np.int64, len(held))
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for word in words_in(text):
                held[word] += 1
            held[END] += 1
            if len(held) > 1_000_000:
                yield handed_on()
                held.clear()
    if held:
        yield handed_on()


def score_texts(docs: DataFrame, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """Scores every text with the model of the texts that are not held out.

    Returns `doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`; log10. A
    null or empty text is one end token. A null doc_id trains. Repeated rows are counted and
    scored one by one; other columns are ignored. Without any training text all probabilities
    are those of one unseen token.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    texts = docs.select("doc_id", "text", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    total = (size["bytes"] or 0) + size["rows"]
    chunks = max(1, -(-total // CHUNK_BYTES))
    bits = max(0, (total * order // SHARD_BYTES)).bit_length()
    counted = texts.filter("not held_out").select("text").mapInArrow(_types, "word long, n long")
    types = counted.groupBy("word").agg(F.sum("n").alias("n")).agg(F.sum("n").alias("n"), F.count("*").alias("types")).first()
    n_tokens, n_types = types["n"] or 0, types["types"]

    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    by_chunk = dealt.groupBy("chunk")
    asked = by_chunk.applyInArrow(_requests(order, bits), "chunk long, shard int, grams binary, counts binary")
    answers = asked.groupBy("shard").applyInArrow(_sums, "chunk long, shard int, counts binary")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_scores(order, prior, n_tokens, n_types), SCORES)
