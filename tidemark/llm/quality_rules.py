"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure of a text comes from its own row, so there is no shuffle at all: a hot source
or a long text costs its own length only. Repeated windows are found by sorting the hashes
of a text's three-word windows; the positions are sorted only for texts that repeat one.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, once, words_of

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or an at from "
    "le la les de des et un une du que qui en au pour par sur est "
    "der die das und ist nicht mit von den dem ein eine zu als auf "
    "el los las y con por para es se no lo su al del"
).split()
STOP_FORMS = [form for word in STOP_WORDS for form in (word, word.capitalize(), word.upper())]


@dataclass(frozen=True)
class Rule:
    """A measure, the measure it is divided by, and the closed interval that passes."""

    name: str
    measure: str
    per: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("length", "n_words", "one", 50, 1_000_000),
    Rule("mean_word_length", "word_chars", "n_words", 2.5, 14),
    Rule("symbols", "n_symbols", "n_words", None, 0.2),
    Rule("capitals", "n_capitals", "word_chars", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.06, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
)


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a row of measures breaks. A ratio over nothing breaks none."""
    broken = []
    for rule in rules:
        value = F.col(rule.measure) / F.nullif(F.col(rule.per), F.lit(0)) if rule.per != "one" else F.col(rule.measure)
        bounds = []
        if rule.least is not None:
            bounds.append(value < rule.least)
        if rule.most is not None:
            bounds.append(value > rule.most)
        test = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
        broken.append(F.when(F.coalesce(test, F.lit(False)), F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def _windows() -> Column:
    starts = F.slice("words", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda word, i: F.xxhash64(word, *(F.get("words", i + k) for k in range(1, WINDOW))))


def _repeated_words() -> Column:
    """Words in the windows at `starts`: each adds those up to the next one, at most its own three."""
    added = F.transform(
        "starts",
        lambda start, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - start, F.lit(WINDOW))),
    )
    return F.coalesce(F.aggregate(added, F.lit(0), lambda total, n: total + n), F.lit(0))


def measures(docs: DataFrame) -> DataFrame:
    """`doc_id` and the measures of each text. A null text has no words.

    n_words, word_chars (code points in words), n_symbols, n_capitals (A-Z), n_lines (lines
    with a word), n_dup_lines, n_stop_words, n_repeat_words: long. Repeated rows are measured
    one by one; other columns of `docs` are ignored.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    split = once(docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text")), words=words_of(text), lines=lines)
    hashed = once(split, windows=_windows())
    # Only texts that repeat a window have their windows sorted along with the positions.
    placed = once(
        hashed,
        placed=F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda x, k: F.coalesce(F.get("placed", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("placed", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1)))
    starts = once(placed, starts=F.sort_array(F.transform(twice, lambda x: x["i"])))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.char_length("text") - F.regexp_count("text", F.lit(f"[{SPACES}]")),
        "n_symbols": F.regexp_count("text", F.lit(f"[{SYMBOLS}]")),
        "n_capitals": F.regexp_count("text", F.lit("[A-Z]")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_stop_words": F.size(F.filter("words", lambda word: word.isin(STOP_FORMS))),
        "n_repeat_words": _repeated_words(),
    }
    counted = once(starts, **{name: count.cast("long") for name, count in counts.items()})
    return counted.select("doc_id", *counts)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures of every text, `base_failed`, the rules it breaks and whether it is `kept`.

    An empty or null text fails the base; an empty table gives no rows.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measures(docs).withColumn("base_failed", failed).withColumn("broken", compiled(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
