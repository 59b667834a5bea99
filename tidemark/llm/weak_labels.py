"""Quality classifier trained from weak labels.

Heuristic labellers vote good, bad or not at all on every document. Expectation-maximisation
over the vote patterns, counted by Spark over all documents, estimates how often each
labeller votes what on good and on bad documents. The posterior of its pattern labels each
document of a bounded sample, on which a linear scorer over hashed token shapes is trained.
The scorer judges every document from its own text.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Documents the scorer is trained on, at most: different ones, by the smallest hashes of id and text.
TRAIN_DOCUMENTS = 4000
BUCKETS = 1 << 14
ROUNDS = 60
STEPS, RATE, RIDGE = 800, 4.0, 1e-5
THRESHOLD = 0.5
# Too short for ratios to mean anything.
FEW_WORDS = 12
EXTRA_WORDS = 20

# Frequent function words of the four languages of the corpus.
FUNCTION_WORDS = frozenset(
    (
        "the of and to in a is that for it as was with be by on not he this are or an at from "
        "le la les de des et un une du que qui en au pour par sur est "
        "der die das und ist nicht mit von den dem ein eine zu als auf "
        "el los las y con por para es se no lo su al del"
    )
    .encode()
    .split()
)
# Characters by class: a letter (all beyond ASCII too), A capital, 0 digit, the rest as it is.
CLASSES = bytes(
    97 if 97 <= c <= 122 or c > 127 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.DOTALL)
SYMBOLS = b"#*$%&|<>"
LABELLERS = ("symbols", "capitals", "function_words", "neighbours", "variety", "lines", "word_length", "marks")


@dataclass
class Text:
    words: list[bytes]
    lines: list[bytes]
    raw: bytes
    shapes: Counter
    neighbours: int


def parse(text: str | None) -> Text:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    shapes = Counter(RUNS.sub(rb"\1", raw.translate(CLASSES)).split())
    same = sum(map(bytes.__eq__, words, words[1:]))
    return Text(words, [line for line in raw.split(b"\n") if line.strip()], raw, shapes, same)


def votes(text: Text) -> str:
    """One letter per labeller: g good, b bad, - none."""
    n = len(text.words)
    if n == 0:
        return "-" * len(LABELLERS)

    def vote(value: float, good: float, bad: float) -> str:
        """Good up to `good`, bad from `bad` on, or the other way round if bad is smaller."""
        if good <= bad:
            return "g" if value <= good else "b" if value >= bad else "-"
        return "g" if value >= good else "b" if value <= bad else "-"

    symbols = sum(map(text.raw.count, (bytes([c]) for c in SYMBOLS)))
    letters = max(1, sum(map(len, text.words)))
    capitals = letters - len(b"".join(text.words).translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    long_enough = n >= FEW_WORDS
    function_words = sum(map(FUNCTION_WORDS.__contains__, text.words)) / n
    lines = 1 - len(set(text.lines)) / len(text.lines)
    return "".join(
        (
            vote(symbols / n, 0.02, 0.15),
            vote(capitals / letters, 0.12, 0.4),
            vote(function_words, 0.12, 0.05) if long_enough else "-",
            vote(text.neighbours / n, 0.06, 0.25) if n > 4 else "-",
            vote(len(set(text.words)) / n, 0.35, 0.08) if long_enough else "-",
            vote(lines, 0.3, 0.6) if len(text.lines) > 2 else "-",
            vote(letters / n, 12, 20) if long_enough else "-",
            vote((text.raw.count(b"!") + text.raw.count(b"?")) / n, 0.3, 0.8),
        )
    )


def features(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values: shares of token shapes, function words, repeated words and neighbours.

    Shares are of a few words more than there are, so that short texts show little either way.
    """
    n = len(text.words) + EXTRA_WORDS
    shares = {b"s:" + shape: count / n for shape, count in text.shapes.items()}
    shares[b"function"] = sum(map(FUNCTION_WORDS.__contains__, text.words)) / n
    shares[b"neighbours"] = text.neighbours / n
    shares[b"repeated"] = (len(text.words) - len(set(text.words))) / n
    shares[b"lines"] = (len(text.lines) - len(set(text.lines))) / (len(text.lines) + 3)
    shares[b"one"] = 1.0
    hashes = np.fromiter((xxhash.xxh32_intdigest(name) for name in shares), np.int64, len(shares)) % BUCKETS
    return hashes, np.sqrt(np.fromiter(shares.values(), float, len(shares)))


@dataclass(frozen=True)
class LabelModel:
    """P(good), and P(vote | class, not silent) by labeller, class (bad, good) and vote (g, b).

    Silence says nothing: a short text is no better or worse for the labellers it is too short for.
    """

    good: float
    votes: np.ndarray

    def posterior(self, pattern: str) -> float:
        logs = np.log([1 - self.good, self.good])
        for labeller, vote in enumerate(pattern):
            if vote != "-":
                logs = logs + np.log(self.votes[labeller, :, "gb".index(vote)])
        odds = np.exp(logs - logs.max())
        return float(odds[1] / odds.sum())


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from labellers that seldom call a good document bad. Each estimate keeps a
    little of that start, as if a few documents had shown it.
    """
    start = np.tile(np.array([[0.6, 0.4], [0.99, 0.01]]), (len(LABELLERS), 1, 1))
    model = LabelModel(0.85, start)
    if not patterns:
        return model
    names, counts = list(patterns), np.array(list(patterns.values()), float)
    seen = np.array([["gb-".index(vote) for vote in name] for name in names])
    weight = max(1.0, counts.sum() * 0.002)
    for _ in range(rounds):
        good = np.array([model.posterior(name) for name in names])
        mass = np.stack([(1 - good) * counts, good * counts])
        table = start * weight
        for labeller in range(len(LABELLERS)):
            for cls in (0, 1):
                table[labeller, cls] += np.bincount(seen[:, labeller], mass[cls], minlength=3)[:2]
        share = (mass[1].sum() + 0.85 * weight) / (counts.sum() + weight)
        model = LabelModel(float(share), table / table.sum(axis=2, keepdims=True))
    return model


def train(rows: list[tuple[list[int], list[float], float]]) -> np.ndarray:
    """Weights of a logistic scorer, by gradient steps over all rows."""
    weights = np.zeros(BUCKETS)
    if not rows:
        return weights
    buckets = np.concatenate([np.asarray(b, np.int64) for b, _, _ in rows])
    values = np.concatenate([np.asarray(v, float) for _, v, _ in rows])
    row = np.repeat(np.arange(len(rows)), [len(b) for b, _, _ in rows])
    good = np.array([g for _, _, g in rows])
    for _ in range(STEPS):
        guess = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights[buckets] * values, len(rows)), -30, 30)))
        slope = np.bincount(buckets, ((guess - good) / len(rows))[row] * values, BUCKETS)
        weights -= RATE * (slope + RIDGE * weights)
    return weights


def _vote(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([votes(parse(text)) for text in part], dtype=object)


def _features(texts: pd.Series) -> pd.DataFrame:
    made = [features(parse(text)) for text in texts]
    return pd.DataFrame({"buckets": [b for b, _ in made], "values": [v for _, v in made]})


@dataclass(frozen=True)
class Classifier:
    labels: LabelModel
    weights: np.ndarray

    def probability(self, text: str | None) -> float:
        """Of being good. A text without words has no evidence and gets zero."""
        parsed = parse(text)
        if not parsed.words:
            return 0.0
        buckets, values = features(parsed)
        return float(1 / (1 + np.exp(-np.clip((self.weights[buckets] * values).sum(), -30, 30))))


def fit(docs: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> Classifier:
    """Label model from the votes on all of `doc_id, text`, scorer from a bounded sample.

    Labels are taken from no table. Vote patterns are at most three to the power of the
    labellers, counted before they reach the driver.
    """
    voted = docs.select(F.pandas_udf(_vote, "string")("text").alias("pattern"))
    patterns = {row["pattern"]: row["count"] for row in voted.groupBy("pattern").count().collect()}
    labels = estimate(patterns)
    # The share of places that holds about twice the sample goes on to the ordering, whose one
    # task would otherwise read a full sample from every partition.
    share = min(1.0, 2 * train_documents / max(1, sum(patterns.values())))
    chosen = (
        docs.select("text", F.xxhash64("doc_id", F.xxhash64("text")).alias("place"))
        .filter(F.col("text").isNotNull() & (F.col("place") <= int(share * 2**64) - 2**63 - 1))
        .dropDuplicates(["place"])
        .orderBy("place")
        .limit(train_documents)
    )
    measured = chosen.select(
        F.pandas_udf(_vote, "string")("text").alias("pattern"),
        F.pandas_udf(_features, "buckets array<bigint>, values array<double>")("text").alias("f"),
    )
    rows = [(r["f"]["buckets"], r["f"]["values"], labels.posterior(r["pattern"])) for r in measured.collect() if r["pattern"].strip("-")]
    return Classifier(labels, train(rows))


def judge(docs: DataFrame, model: Classifier | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with `quality` (probability of being good) and `kept`.

    Columns of these names are replaced. A null, empty or wordless text has quality zero and
    is rejected. Repeated rows are judged alike; an empty table gives no rows.
    """
    fitted = model or fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([shared.value.probability(text) for text in part], dtype=float)

    scored = docs.withColumn("quality", F.pandas_udf(score, "double")("text"))
    return scored.withColumn("kept", F.col("quality") >= threshold)
