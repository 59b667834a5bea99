"""Personal data by bootstrapped contextual extraction.

Matches of the base patterns are seeds. The words left and right of seeds and of other
identifier-like tokens are lexical patterns. Patterns and instances form a bipartite graph
that is scored for a few rounds: a pattern by the share of its instances that are trusted,
an unseen instance by its best pattern. Unseen candidates in a context of high score and enough
distinct seeds are found as well; base spans always stay. Candidates are tokens with digits,
groups of digits over several tokens, and words shaped like addresses. Each of these shapes is
weighed by itself against the seeds, so that many short numbers beside a pattern do not speak
against the long ones there.

Secrets are a kind of the method's own: what a word for one is set to is a seed, and long tokens of
letters and digits in the contexts of such seeds are found with them.

The base scan is linear in the text: runs are found whole instead of tried from each place.
"""

import bisect
import itertools
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
SECRET_KIND = KINDS.index("secret")
ROUNDS = 3
DAMPING = 0.9
MIN_SCORE = 0.8
MIN_SEEDS = 3
# Shapes of candidates: a token with MIN_DIGITS digits or more, one with fewer and no letters,
# groups of digits over several tokens, address-like words, and long tokens of letters and digits.
SHAPES = TOKEN, SHORT, GROUPS, ADDRESS, MIXED = range(5)
MIN_DIGITS = 6
# No base span has more.
MAX_DIGITS = 19

LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+")
WORD = re.compile(r"[^ \t-\r]+")
NEAR = re.compile(r"[^ \t-\r]{1,40}")
GROUPED = re.compile(r"[0-9]+(?:(?:\) ?| ?\(|[ .-])[0-9]+)*")
# An address that is spelled out or has no dotted domain, and names like jane.doe, jane_doe, @jane.
AT = re.compile(r" ?[\[({] ?(?:at|AT|@) ?[\])}] ?| at | AT | @ ")
SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?: ?[\[({] ?(?:dot|DOT|\.) ?[\])}] ?| dot | DOT |\.)[A-Za-z0-9-]{1,63})+")
ADDRESS_LIKE = re.compile(r"(?<=[A-Za-z])[._](?=[A-Za-z])|@(?=[A-Za-z])")
SPACES = " \t\n\x0b\x0c\r"
# Words that a secret is set to.
SECRET_WORDS = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key", "private_key")
MIN_SECRET, MAX_SECRET = 12, 512
# What is set, from the sign on. A run longer than a key is may be a text: it is taken whole or not at all.
SET = re.compile(rf"[:=] ?[\"']?([A-Za-z0-9_+/=.-]{{{MIN_SECRET},}}+)")
LONG_TOKEN = re.compile(rf"[A-Za-z0-9_+/-]{{{MIN_SECRET},}}+")

# Address-like words are like e-mail addresses, numbers like the other kinds; a long token may be either.
# Mixed tokens are secrets, and secrets mixed tokens.
FITS = (
    f"(shape = {MIXED}) = (kind = {SECRET_KIND})"
    f" and (shape in ({TOKEN}, {MIXED}) or (shape = {ADDRESS}) = (kind = {KINDS.index('email')}))"
)

SPAN = "struct<kind: int, start: int, end: int>"
MENTION = "struct<kind: int, start: int, end: int, shape: int, instance: bigint, left: string, right: string>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        parts, start = run.group().split("."), run.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in DIGITS.finditer(text):
        if 16 <= run.end() - run.start() <= 37:
            digits = run.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    # No run holds a second plus, so each one starts a run of its own.
    for run in PLUS.finditer(text):
        number = run.group().rstrip(" ().-")
        if len(number) >= 4 and 8 <= sum(c in "0123456789" for c in number) <= 15:
            yield run.start(), run.start() + len(number)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    finders = (emails, addresses, cards, phones)
    return [(kind, start, end) for kind, find in enumerate(finders) for start, end in find(text)]


def _looks_random(value: str) -> bool:
    """Whether a token of letters and digits is as long and as mixed as a key."""
    if len(value) < MIN_SECRET or len(value) > MAX_SECRET or not DOTTED.search(value):
        return False
    digits = sum(c in "0123456789" for c in value)
    return digits >= 3 and sum(c.isalpha() for c in value) >= 3


def secrets(text: str) -> Iterator[tuple[int, int]]:
    for found in SET.finditer(text):
        before = text[max(0, found.start() - 16) : found.start()].rstrip(" ").rstrip("\"'").lower()
        if not before.endswith(SECRET_WORDS):
            continue
        begin, end = found.span(1)
        while end > begin and text[end - 1] in ".=-":
            end -= 1
        if _looks_random(text[begin:end]):
            yield begin, end


def _mixed(text: str) -> Iterator[tuple[int, int]]:
    for run in LONG_TOKEN.finditer(text):
        if _looks_random(run.group()):
            yield run.span()


def _context(text: str, start: int, end: int) -> tuple[str, str]:
    """The nearest words before and after a span, lower-cased, digits as zeros."""
    stop = start
    while stop > 0 and text[stop - 1] in SPACES:
        stop -= 1
    begin = stop
    # A word much longer than words are is cut; it is no pattern.
    while begin > 0 and stop - begin < 40 and text[begin - 1] not in SPACES:
        begin -= 1
    after = NEAR.search(text, end)
    return tuple(re.sub("[0-9]", "0", word.lower()) for word in (text[begin:stop], after.group() if after else ""))


def _token(text: str, at: int, done: int) -> tuple[int, int, int]:
    """The token around a place, without its edges, and where it ends with them."""
    begin = at
    while begin > done and text[begin - 1] not in SPACES:
        begin -= 1
    stop = end = WORD.match(text, begin).end()
    while begin < end and not text[begin].isalnum():
        begin += 1
    while end > begin and not text[end - 1].isalnum():
        end -= 1
    return begin, end, stop


def _digit_groups(text: str) -> Iterator[tuple[int, int]]:
    for run in GROUPED.finditer(text):
        begin, end = run.span()
        apart = (begin == 0 or not text[begin - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
        if apart and " " in run.group() and sum(c in "0123456789" for c in run.group()) <= MAX_DIGITS:
            if ")" in run.group() and text[begin - 1 : begin] == "(":
                begin -= 1
            yield begin - (text[begin - 1 : begin] == "+"), end


def _address_like(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for sign in AT.finditer(text):
        domain = SPELLED.match(text, sign.end())
        begin = sign.start()
        while begin > done and text[begin - 1] in LOCAL_CHARS:
            begin -= 1
        if domain and begin < sign.start() and sign.start() >= done:
            yield begin, domain.end()
            done = domain.end()
    done = 0
    for sign in ADDRESS_LIKE.finditer(text):
        if sign.start() >= done:
            begin, end, done = _token(text, sign.start(), done)
            if begin < end:
                yield begin, end


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(shape, start, end) of what may be an identifier; some lie in others."""
    groups = list(_digit_groups(text))
    yield from ((GROUPS, *group) for group in groups)
    yield from ((ADDRESS, *words) for words in _address_like(text))
    yield from ((MIXED, *token) for token in _mixed(text))
    done, place = 0, 0
    for run in DOTTED.finditer(text):
        if run.start() < done:
            continue
        begin, end, done = _token(text, run.start(), done)
        value = text[begin:end]
        if sum(c in "0123456789" for c in value) >= MIN_DIGITS:
            yield TOKEN, begin, end
            continue
        while place < len(groups) and groups[place][1] <= begin:
            place += 1
        # A part of a longer number is none by itself.
        if begin < end and (place == len(groups) or groups[place][0] >= end):
            yield ADDRESS if any(c.isalpha() for c in value) else SHORT, begin, end


def _free(taken: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a span meets none of those taken, which are in order."""
    starts, ends = [start for start, _ in taken], [0, *itertools.accumulate((end for _, end in taken), max)]
    return lambda start, end: ends[bisect.bisect_left(starts, end)] <= start


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """Seeds and candidates, which have no kind, with their contexts."""
    found, taken = [], sorted((start, end) for _, start, end in spans)
    for kind, start, end in spans:
        found.append((kind, start, end, None, _instance(text[start:end]), *_context(text, start, end)))
    free = _free(taken)
    for shape, start, end in dict.fromkeys(candidates(text)):
        if free(start, end):
            found.append((None, start, end, shape, _instance(text[start:end]), *_context(text, start, end)))
    return found


def _instance(value: str) -> int:
    """Instances are told apart by hash: no personal data leaves its text."""
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63)


def _scan(texts: pd.Series) -> pd.DataFrame:
    spans, secret, found = [], [], []
    for text in texts:
        text = text or ""
        here = base_spans(text)
        spans.append([{"kind": k, "start": a, "end": b} for k, a, b in here])
        names = ("kind", "start", "end", "shape", "instance", "left", "right")
        # A base span stays what it is.
        free = _free(sorted((start, end) for _, start, end in here))
        own = [(SECRET_KIND, *span) for span in secrets(text) if free(*span)]
        secret.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
        found.append([dict(zip(names, mention, strict=True)) for mention in mentions(text, here + own)])
    return pd.DataFrame({"base": spans, "secrets": secret, "mentions": found})


def scanned(docs: DataFrame, name: str) -> DataFrame:
    """The columns of `docs`, a number for each row, its base spans and its mentions; stored."""
    scan = F.pandas_udf(_scan, f"base array<{SPAN}>, secrets array<{SPAN}>, mentions array<{MENTION}>")
    rows = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_found", scan(F.col("text")))
    return stored(rows.select("*", "_found.*").drop("_found"), name)


def accepted_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """`shape, pattern, kind, score` of the patterns that are trusted, from `pattern, instance, kind, shape` edges.

    Instances of a pattern are, for each shape, its seeds and its candidates of that shape.
    Instances that accepted patterns found support other patterns as seeds do, in all shapes,
    by their lower trust. There are at least `rounds` rounds, and more until one accepts none.
    """
    edges = stored(found.select("pattern", "instance", "kind", "shape").distinct(), "pii-edges")
    every = F.array(*[F.lit(shape) for shape in SHAPES])
    unseen = edges.filter("kind is null")
    of_seeds = edges.filter("kind is not null").withColumn("shape", F.explode(every))
    members = of_seeds.union(unseen).select("shape", "pattern", "instance").distinct()
    sizes = members.groupBy("shape", "pattern").agg(F.count("*").alias("instances"))
    # An instance that is a seed somewhere is one everywhere.
    nodes = stored(edges.groupBy("pattern", "instance").agg(F.collect_set("shape").alias("shapes")), "pii-nodes")
    seeds = edges.filter("kind is not null").select("instance", "kind").distinct()
    seeds = seeds.select("*", F.lit(1.0).alias("trust"), F.lit(True).alias("sure"))
    trust, accepted, done = seeds, None, 0
    for turn in itertools.count(1):
        held = nodes.join(trust, "instance").withColumn("shape", F.explode(F.when(F.col("sure"), every).otherwise(F.col("shapes"))))
        # What was found in other shapes is not among the instances that are counted: it adds
        # its trust to both sides, which lowers no share.
        extra = F.when((F.col("trust") < 1.0) & ~F.array_contains("shapes", F.col("shape")), F.col("trust")).otherwise(0.0)
        summed = held.groupBy("shape", "pattern", "kind").agg(
            F.sum("trust").alias("trusted"), F.sum(extra).alias("extra"), F.count_if("sure").alias("seeds")
        )
        # One more instance in the count: a pattern of few seeds is not trusted at once.
        share = F.col("trusted") / (F.col("instances") + 1 + F.col("extra"))
        scored = summed.join(sizes, ["shape", "pattern"]).withColumn("score", share).filter(FITS)
        sure = (F.col("score") >= MIN_SCORE) & (F.col("seeds") >= MIN_SEEDS)
        scores = stored(scored.select("shape", "pattern", "kind", "score", sure.alias("sure")), "pii-scores")
        accepted, before = scores.filter("sure"), done
        done = accepted.count()
        if turn >= rounds and done <= before:
            return accepted.select("shape", "pattern", "kind", "score")
        beside = unseen.select("shape", "pattern", "instance").join(scores, ["shape", "pattern"])
        found_by = beside.groupBy("instance", "kind").agg((F.max("score") * DAMPING).alias("trust"), F.max("sure").alias("sure"))
        trust = seeds.union(found_by.join(seeds, ["instance", "kind"], "left_anti"))


def _outer(found: pd.Series) -> pd.Series:
    """The spans that lie in no other one, from spans by start, the longest first."""
    kept = []
    for spans in found:
        here, reach = [], 0
        for span in spans:
            if -span["back"] > reach:
                reach = -span["back"]
                here.append({"kind": span["kind"], "start": span["start"], "end": reach})
        kept.append(here)
    return pd.Series(kept, dtype=object)


def with_spans(docs: DataFrame, name: str) -> DataFrame:
    """`docs`, which has none of these columns, with `base` and `spans`: all spans, by kind, then start."""
    table = scanned(docs, name)
    mention = table.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*")
    sides = F.array(
        F.when(F.col("left") != "", F.concat(F.lit("L:"), "left")),
        F.when(F.col("right") != "", F.concat(F.lit("R:"), "right")),
    )
    found = mention.withColumn("pattern", F.explode(F.array_compact(sides)))
    patterns = accepted_patterns(found).withColumnRenamed("kind", "found_kind")
    unseen = found.filter("kind is null").join(patterns, ["shape", "pattern"])
    # Of several kinds the best score wins, then the kind listed first.
    best = unseen.groupBy("_row", "start", "end").agg(F.max_by("found_kind", F.struct("score", -F.col("found_kind"))).alias("kind"))
    added = best.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "kind"))).alias("added"))
    outer = F.pandas_udf(_outer, f"array<{SPAN}>")
    added = stored(added.select("_row", outer("added").alias("added")), "pii-added")
    joined = table.drop("mentions").join(added, "_row", "left")
    none = F.array().cast(f"array<{SPAN}>")
    spans = F.sort_array(F.concat("base", "secrets", F.coalesce("added", none)))
    return joined.withColumn("spans", spans).drop("_row", "added", "secrets")


def digest(spans: str) -> Column:
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def find(docs: DataFrame) -> DataFrame:
    """A row per document: `doc_id`, counts of each base kind, `base_sha256`, `spans`.

    Spans are `kind:start:end` in code points, end exclusive. A null text is empty. Repeated
    rows are searched one by one; other columns are ignored.
    """
    rows = with_spans(docs.select("doc_id", "text"), "pii-texts").drop("text")
    counts = [
        F.size(_of_kind(number)).cast("long").alias(f"n_{kind}") for number, kind in enumerate(BASE_KINDS)
    ]
    return rows.select("doc_id", *counts, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


def _of_kind(number: int) -> Column:
    return F.filter("base", lambda span: span["kind"] == number)


def _mask(text: pd.Series, spans: pd.Series) -> pd.Series:
    masked = []
    for value, found in zip(text, spans, strict=True):
        pieces, at = [], 0
        for span in sorted(found, key=lambda s: (s["start"], -s["end"])) if value is not None else ():
            if span["end"] > at:
                if span["start"] >= at:
                    pieces += [value[at : span["start"]], f"[{KINDS[span['kind']].upper()}]"]
                at = span["end"]
        masked.append(value if value is None or not at else "".join([*pieces, value[at:]]))
    return pd.Series(masked, dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets, and `n_chars` to match.

    Other columns, whatever their names, pass through. A null text stays null.
    """
    mask = F.pandas_udf(_mask, "string")
    # The other columns travel as one, so that no name of theirs meets one of this module.
    rest = [F.col(f"`{name.replace('`', '``')}`") for name in docs.columns if name != "text"]
    rows = with_spans(docs.select(F.struct(*rest, F.lit(0).alias("")).alias("_doc"), "text"), "pii-docs")
    found = F.size("spans") > 0
    masked = rows.withColumn("text", F.when(found, mask("text", "spans")).otherwise(F.col("text")))
    columns = []
    for name in docs.columns:
        column = F.col("text") if name == "text" else F.col("_doc").getField(name)
        if name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            column = F.when(found, F.coalesce(F.char_length("text").cast(kind), column)).otherwise(column)
        columns.append(column.alias(name))
    return masked.select(*columns)
