"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so that a question with other numbers or
names in it keeps its template. A capitalised word at a sentence start may be a name or not;
windows are made for both readings, and either may match. A window with few words of its own
is keyed by all its words instead, and passages of PASSAGE words are matched word for word
besides, whatever is in them; an item shorter than that is one passage. Windows of template tokens are joined with the benchmark's by
hash. Matches that align a document with an item are checked for slot consistency: one value
of the item must stand for one value in the document. The check is made for the whole
alignment, for each run of windows that follow on one another, and for each run whose slots
are equal word for word, which is always consistent.

Benchmark windows are counted. Up to FILTER_WINDOWS their hashes go to the tasks, which then
pass on matching windows only; beyond that all windows go to the join, with the same result.
"""

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, stored, text_key

WINDOW = 8
# Windows that must match in one alignment; items with fewer must match in all.
MIN_WINDOWS = 4
# Tokens of a window that are words of their own; one with fewer matches word for word only.
MIN_LITERALS = 4
# Words that are as long as the fewest windows of a longer item.
PASSAGE = WINDOW + MIN_WINDOWS - 1
# 8 bytes each in every task.
FILTER_WINDOWS = 2_000_000
FOLD_WINDOWS = 1 << 18
# Readings of windows that are worked out at a time.
FOLD_READINGS = 1 << 18
FOLD_WORDS = 1 << 13
# Characters of the texts that are in arrays at a time.
FOLD_CHARS = 1 << 21

EDGES = re.compile(r"^[\W_]+|[\W_]+$")
NUMBER = re.compile(r"[0-9][0-9.,:/-]*(?:st|nd|rd|th)?\Z")
MEASURE = re.compile(r"([0-9][0-9.,]*)([^\W0-9_]+)\Z")
# Words for numbers, and common units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg lb lbs pound pounds oz ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days "
    "week weeks month months year years percent degree degrees dollar dollars euro euros cent cents mph kmh".split()
)
LITERAL, NUM, NAME, UNIT, GLUE = range(5)
PLACEHOLDERS = np.array([0, 0x51ED270B, 0x2545F491, 0x9E3779B1, 0], dtype=np.uint64)
BASE = np.uint64(0x100000001B3)
POWERS = BASE ** np.arange(64, dtype=np.uint64)
# Keeps windows keyed by words, and passages, apart from those of template tokens.
SPELLED, VERBATIM = np.uint64(1 << 40), np.uint64(1 << 41)

# `next_at` and `next` are where the window's second token is, `plain` that no word is read as a name,
# `dense` that it has enough literals; a passage has no slots.
TEMPLATES = (
    "item long, item_id long, window long, at long, next_at long, end long, size long, item_plain boolean, dense boolean, width int,"
    " item_slots array<string>"
)
TEMPLATE_NAMES = [column.split()[0] for column in TEMPLATES.split(", ")]
TEMPLATE_TYPES = (*[pa.int64()] * 7, pa.bool_(), pa.bool_(), pa.int32(), pa.list_(pa.string()))
WINDOWS = "window long, position long, next long, plain boolean, slots array<string>"
WINDOW_NAMES = [column.split()[0] for column in WINDOWS.split(", ")]
PAIR = ("at", "next_at", "end", "size", "item_plain", "dense", "item_slots", "position", "next", "plain", "slots")


class Lexicon(dict):
    """What each raw token is, worked out once per distinct token: its number here.

    `hash`, `kind` (a capitalised word is a NAME, which at a sentence start may be a literal too),
    `ends` (whether a sentence ends with it) and `core` (the token without its edges).
    """

    def __init__(self):
        self.hash, self.kind, self.ends, self.core = [], [], [], []
        self.known = np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, bool)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`hash`, `kind` and `ends`; what is new is added to those of the last call."""
        done = len(self.known[0])
        if done < len(self.core):
            new = (self.hash, self.kind, self.ends)
            self.known = tuple(np.append(old, np.array(some[done:], old.dtype)) for old, some in zip(self.known, new, strict=True))
        return self.known

    def __missing__(self, raw: str) -> int:
        # Most tokens need no pattern: both begin with a digit, and edges are no letters or digits.
        bare = raw[-1].isalnum()
        core = raw if bare and raw[0].isalnum() else EDGES.sub("", raw)
        folded = core.lower()
        if not core:
            kind = GLUE
        elif folded in NUMBER_WORDS or folded[0] in "0123456789" and (NUMBER.match(folded) or MEASURE.match(folded)):
            kind = NUM
        elif folded in UNITS:
            kind = UNIT
        elif core[0].isupper() and (len(core) == 1 or core[1:].islower()):
            kind = NAME
        else:
            kind = LITERAL
        self.hash.append(xxhash.xxh64_intdigest(folded.encode("utf-8", "surrogatepass"), 3))
        self.kind.append(kind)
        self.ends.append(not bare and raw.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":", ";", "…"))
        self.core.append(folded)
        self[raw] = len(self.core) - 1
        return self[raw]


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """The sum of code k times BASE to the power k over `width` codes from each place, by halves."""
    if width == 1:
        return codes
    half = width // 2
    low = _rolled(codes, half)
    high = low if width == 2 * half else _rolled(codes, width - half)
    n = len(codes) - width + 1
    return low[:n] + high[half : half + n] * POWERS[half]


def _finished(sums: np.ndarray, width: int, seed: np.uint64 = np.uint64(0)) -> np.ndarray:
    mixed = (sums ^ seed ^ np.uint64(width)) * PLACEHOLDERS[UNIT]
    return mixed ^ (mixed >> np.uint64(31))


def _of_text(text: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Hashes that tell texts apart too."""
    mixed = (hashed ^ (hashed >> np.uint64(32))) * PLACEHOLDERS[UNIT] + (text.astype(np.uint64) + np.uint64(1)) * BASE
    return mixed ^ (mixed >> np.uint64(29))


class Template:
    """The template tokens of one text after another, in flat arrays."""

    def __init__(self, texts: list[str | None], lexicon: Lexicon):
        split = [(text or "").split() for text in texts]
        ids = np.fromiter((lexicon[raw] for words in split for raw in words), np.int64)
        text_of = np.repeat(np.arange(len(split)), [len(words) for words in split])
        hashes, kinds, sentence_ends = lexicon.arrays()
        kind, ends = kinds[ids], sentence_ends[ids]
        # Tokens without letters or digits only tell where sentences end.
        solid = kind != GLUE
        begins = np.ones(len(ids), bool)
        begins[1:] = ends[:-1] | (text_of[1:] != text_of[:-1])
        glued = np.flatnonzero(~solid)
        begins[glued[glued + 1 < len(ids)] + 1] |= begins[glued[glued + 1 < len(ids)]]
        ids, text_of, kind, begins = ids[solid], text_of[solid], kind[solid], begins[solid]
        same = np.zeros(len(ids), bool)
        same[1:] = text_of[1:] == text_of[:-1]
        before = np.full(len(ids), LITERAL, np.int8)
        before[1:] = kind[:-1]
        either = (kind == NAME) & begins
        kind = np.where(either, LITERAL, kind)
        kind = np.where((kind == UNIT) & ~(same & (before == NUM)), LITERAL, kind)
        # A name of several words is one slot.
        first = np.ones(len(ids), bool)
        first[1:] = ~((kind[1:] == NAME) & (kind[:-1] == NAME) & same[1:])
        # Where each token begins in the words, which are `words`.
        self.words, self.origin = ids, np.append(np.flatnonzero(first), len(ids))
        self.ids, self.text_of, self.kind = ids[first], text_of[first], kind[first]
        # Read as a name, a word takes in the names that follow it.
        self.either, self.takes = either[first], np.zeros(len(self.ids), np.int64)
        self.takes[:-1] = self.either[:-1] & (self.kind[1:] == NAME) & (self.text_of[1:] == self.text_of[:-1])
        literal = hashes[self.ids]
        # All words of each token, and the words as they are.
        self.word = hashes[ids]
        self.word_start = np.searchsorted(text_of, np.arange(len(texts)))
        self.word_size = np.bincount(text_of, minlength=len(texts))
        self.word_text = text_of
        within = np.arange(len(ids)) - np.repeat(self.origin[:-1], np.diff(self.origin))
        spelled = self.word * BASE ** within.astype(np.uint64)
        self.spelled = np.add.reduceat(spelled, self.origin[:-1]) if len(ids) else spelled
        self.code = np.where(self.kind == LITERAL, literal, PLACEHOLDERS[self.kind])
        self.start = np.searchsorted(self.text_of, np.arange(len(texts)))
        self.size = np.bincount(self.text_of, minlength=len(texts))
        self.stop = (self.start + self.size)[self.text_of]
        self.lexicon = lexicon

    def windows(self, width: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Every window of `width` tokens in one text, in parts.

        Hash, place, end, and a bit for each token that is a word at a sentence start read as
        a name. The first part has the windows without such words; those with too few literals
        are hashed by their words.
        """
        n = len(self.code) - width + 1
        if n <= 0:
            return
        sums = _rolled(self.code, width)
        mixed = _finished(sums, width)
        literals = np.concatenate(([0], np.cumsum(self.kind == LITERAL)))
        literals = literals[width:] - literals[:-width]
        sparse = np.flatnonzero(literals < MIN_LITERALS)
        spelled = sum((self.spelled[sparse + step] * POWERS[step] for step in range(width)), np.zeros(len(sparse), np.uint64))
        mixed[sparse] = _finished(spelled, width, SPELLED)
        places = np.flatnonzero(self.text_of[:n] == self.text_of[width - 1 :])
        yield mixed[places], places, places + width, np.zeros(len(places), np.int64)
        inside = np.zeros(len(self.code), bool)
        inside[places] = True
        # Windows in which no such word takes in others keep their tokens: their sums change by a term.
        taking = np.concatenate(([0], np.cumsum(self.takes)))
        upto = np.minimum(np.arange(len(self.code)) + width, len(self.code))
        fixed = inside & (taking[upto] == taking[:-1])
        words = np.flatnonzero(self.either)
        for begin in range(0, len(words), FOLD_WORDS):
            yield self._replaced(words, begin, width, sums, literals, fixed)
        # A window has at most as many readings as there are choices in it.
        starts = np.flatnonzero(taking[upto] > taking[:-1])
        choices = np.concatenate(([0], np.cumsum(self.either)))
        reach = np.minimum(starts + 2 * width, len(self.code))
        readings = np.cumsum(1 << np.minimum(choices[reach] - choices[starts], width))
        cuts = np.searchsorted(readings, np.arange(FOLD_READINGS, readings[-1] if len(readings) else 0, FOLD_READINGS))
        for some in np.split(starts, cuts):
            yield self._readings(some, width)

    def _replaced(self, words, begin, width, sums, literals, fixed) -> tuple[np.ndarray, ...]:
        """The readings whose first name is one of some words, in windows that keep their tokens."""
        change = PLACEHOLDERS[NAME] - self.code[words]
        numbers = np.arange(begin, min(begin + FOLD_WORDS, len(words)))
        number, step = np.repeat(numbers, width), np.tile(np.arange(width), len(numbers))
        place = words[number] - step
        ok = np.flatnonzero(place >= 0)
        ok = ok[fixed[place[ok]]]
        number, step, place = number[ok], step[ok], place[ok]
        state = (place, number, sums[place] + change[number] * POWERS[step], literals[place] - 1, 1 << step)
        found = []
        while len(state[0]):
            state = tuple(column[state[3] >= MIN_LITERALS] for column in state)
            found.append(state)
            place, number, total, left, read = state
            more = []
            for ahead in range(1, width):
                other = np.minimum(number + ahead, len(words) - 1)
                step = words[other] - place
                ok = np.flatnonzero((number + ahead < len(words)) & (step < width))
                if not len(ok):
                    break
                step, other = step[ok], other[ok]
                more.append((place[ok], other, total[ok] + change[other] * POWERS[step], left[ok] - 1, read[ok] | 1 << step))
            if not more:
                break
            state = tuple(map(np.concatenate, zip(*more, strict=True)))
        places, _, total, _, read = map(np.concatenate, zip(*(found or [state]), strict=True))
        return _finished(total, width), places, places + width, read

    def _readings(self, begin: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        at, mixed = begin, np.zeros(len(begin), np.uint64)
        literals, read = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        for step in range(width):
            # Windows that leave their text, or cannot have enough literals, end here.
            live = np.flatnonzero((at < self.stop[begin]) & (literals + width - step >= MIN_LITERALS))
            begin, at, mixed, literals, read = begin[live], at[live], mixed[live], literals[live], read[live]
            name = np.flatnonzero(self.either[at])
            mixed = np.append(mixed + self.code[at] * POWERS[step], mixed[name] + PLACEHOLDERS[[NAME]] * POWERS[step])
            literals = np.append(literals + (self.kind[at] == LITERAL), literals[name])
            read = np.append(read, read[name] | 1 << step)
            begin = np.append(begin, begin[name])
            at = np.append(at + 1, at[name] + 1 + self.takes[at[name]])
        kept = np.flatnonzero((read > 0) & (literals >= MIN_LITERALS))
        return _finished(mixed[kept], width), begin[kept], at[kept], read[kept]

    def passages(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of every `width` words in one text."""
        n = len(self.word) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        places = np.flatnonzero(self.word_text[:n] == self.word_text[width - 1 :])
        return _finished(_rolled(self.word, width), width, VERBATIM)[places], places

    def first_of_kind(self, places: np.ndarray, ends: np.ndarray, hashed: np.ndarray, reads: np.ndarray, reach: int) -> np.ndarray:
        """Of some windows, those at places whose surroundings up to `reach` tokens away, as far as the
        windows cover them, stand nowhere earlier in the text.

        What an alignment of up to `reach` tokens holds, its first occurrence holds too, at places that
        are all kept: an earlier place like one of them would begin an earlier occurrence. So a text that
        repeats itself has no more windows than its distinct parts.
        """
        if not len(places):
            return places
        covered = np.zeros(len(self.code) + 1, np.int64)
        np.add.at(covered, places, 1)
        np.add.at(covered, np.minimum(ends, len(self.code)), -1)
        seen = np.cumsum(covered[:-1]) > 0
        token = self.spelled * PLACEHOLDERS[UNIT] + self.either * PLACEHOLDERS[NUM] + (self.takes > 0) * PLACEHOLDERS[NAME]
        marks = np.where(seen, token, np.uint64(0))
        own = (hashed ^ (reads.astype(np.uint64) << np.uint64(33))) * PLACEHOLDERS[NUM]
        np.add.at(marks, places, own ^ (own >> np.uint64(29)))
        powers = np.cumprod(np.full(len(marks) + 1, BASE, np.uint64))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(marks * powers[:-1], dtype=np.uint64)))
        at = np.unique(places)
        begin, stop = self.start[self.text_of[at]], self.stop[at]
        around = sums[np.minimum(at + reach + 1, stop)] - sums[np.maximum(at - reach, begin)]
        # Moved to one place, so that equal surroundings are equal sums.
        backwards = np.cumprod(np.full(len(marks) + 1, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64))
        _, first = np.unique(_of_text(self.text_of[at], around * backwards[at]), return_index=True)
        return np.flatnonzero(np.isin(places, at[first]))

    def slots(self, place: int, width: int, read: int) -> list[str]:
        """`offset=value` of each placeholder in a window."""
        slots = []
        for step in range(width):
            name = read >> step & 1
            after = self.after(place, name)
            if name or self.kind[place] != LITERAL:
                slots.append(f"{step}={self.value(place, after)}")
            place = after
        return slots

    def after(self, place: int, name: int) -> int:
        return int(place + 1 + (self.takes[place] if name & 1 else 0))

    def value(self, begin: int, end: int) -> str:
        """All words of some tokens."""
        return " ".join(self.lexicon.core[word] for word in self.words[self.origin[begin] : self.origin[end]])


def _benchmark_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, item_id, text -> each window and passage of each item; an item shorter than one is one."""
    for batch in batches:
        template = Template(batch.column(2).to_pylist(), Lexicon())
        items = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        rows = []
        for width in range(1, WINDOW + 1):
            for part in template.windows(width):
                for hashed, place, end, read in zip(*part, strict=True):
                    text = template.text_of[place]
                    start, size = int(template.start[text]), int(template.size[text])
                    at, end = int(place) - start, int(end) - start
                    if width == WINDOW or at == 0 and end == size:
                        next_at = template.after(place, int(read)) - start
                        slots = template.slots(int(place), width, int(read))
                        kinds = template.kind[place : place + width]
                        dense = bool(read) or np.count_nonzero(kinds == LITERAL) >= MIN_LITERALS
                        hashed = int(hashed.view(np.int64))
                        rows.append((*items[text], hashed, at, next_at, end, size, read == 0, dense, width, slots))
        for width in range(1, PASSAGE + 1):
            for hashed, place in zip(*template.passages(width), strict=True):
                text = template.word_text[place]
                at, size = int(place - template.word_start[text]), int(template.word_size[text])
                if width == min(PASSAGE, size):
                    rows.append((*items[text], int(hashed.view(np.int64)), at, at + 1, at + width, size, True, False, width, None))
        if rows:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), TEMPLATE_TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=TEMPLATE_NAMES)


def _folds(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of doc_id, text_key, text in parts of about FOLD_CHARS."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
    fold = (np.cumsum(sizes.astype(np.int64)) - sizes) // FOLD_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(fold)) + 1).tolist(), batch.num_rows]
    for begin, end in itertools.pairwise(cuts):
        if end > begin:
            yield batch.slice(begin, end - begin)


def _document_windows(widths: list[int], passages: list[int], known: np.ndarray | None, reach: int):
    # Most windows are told apart by their last bits.
    seen = np.zeros(1 << 20, bool)
    if known is not None:
        seen[(known & np.uint64(len(seen) - 1)).view(np.int64)] = True

    def met(hashed: np.ndarray) -> np.ndarray:
        if known is None:
            return np.arange(len(hashed))
        if not len(known):
            return np.zeros(0, np.int64)
        near = np.flatnonzero(seen[(hashed & np.uint64(len(seen) - 1)).view(np.int64)])
        some = hashed[near]
        return near[known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from windows(batches)
        give_back()

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in itertools.chain.from_iterable(map(_folds, batches)):
            if len(lexicon) > 500_000:
                lexicon = Lexicon()
            template = Template(batch.column(2).to_pylist(), lexicon)
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()

            def rows(texts, hashed, position, after, plain, slots):
                columns = [
                    pa.array([ids[t] for t in texts], pa.int64()),
                    pa.array([keys[t] for t in texts], pa.int64()),
                    pa.array(hashed.view(np.int64)),
                    pa.array(position),
                    pa.array(after),
                    pa.array(plain),
                    pa.array(slots, pa.list_(pa.string())),
                ]
                return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", *WINDOW_NAMES])

            found = []
            for width in widths:
                for hashed, places, ends, reads in template.windows(width):
                    chosen = met(hashed)
                    found.append((hashed[chosen], places[chosen], ends[chosen], reads[chosen], np.full(len(chosen), width)))
            if found:
                hashed, places, ends, reads, width_of = map(np.concatenate, zip(*found, strict=True))
                kept = template.first_of_kind(places, ends, hashed, reads, reach)
                for begin in range(0, len(kept), FOLD_WINDOWS):
                    some = kept[begin : begin + FOLD_WINDOWS]
                    where, read = places[some], reads[some]
                    texts = template.text_of[where]
                    start = template.start[texts]
                    after = where + 1 + template.takes[where] * (read & 1)
                    slots = [template.slots(*window) for window in zip(where, width_of[some], read, strict=True)]
                    yield rows(texts, hashed[some], where - start, after - start, read == 0, slots)
            for width in passages:
                hashed, places = template.passages(width)
                chosen = met(hashed)
                texts = template.word_text[places[chosen]]
                # Where in the text a passage stands does not matter: the first place of each will do.
                _, first = np.unique(_of_text(texts, hashed[chosen]), return_index=True)
                chosen, texts = chosen[first], texts[first]
                for begin in range(0, len(chosen), FOLD_WINDOWS):
                    some, text = chosen[begin : begin + FOLD_WINDOWS], texts[begin : begin + FOLD_WINDOWS]
                    position = places[some] - template.word_start[text]
                    yield rows(text, hashed[some], position, position + 1, position >= 0, [None] * len(some))

    return run


def _runs(pairs: list[dict]) -> Iterator[list[dict]]:
    """Matches of which each follows on another one in both texts."""
    runs = {}
    for pair in sorted(pairs, key=lambda p: (p["position"], p["at"])):
        run = runs.setdefault((pair["position"], pair["at"]), [])
        run.append(pair)
        runs.setdefault((pair["next"], pair["next_at"]), run)
    yield from {id(run): run for run in runs.values()}.values()


def _alignments(pairs: list[dict], need: int) -> Iterator[list[dict]]:
    """Matches in one alignment that are enough, if consistent, or a run of them over the whole item.

    Enough are `need` windows with enough literals, or MIN_WINDOWS of any.
    """

    def enough(some: list[dict]) -> bool:
        dense = {pair["at"] for pair in some if pair["dense"]}
        return len(dense) >= need or len({pair["at"] for pair in some}) >= MIN_WINDOWS

    shifts = {}
    for pair in pairs:
        shifts.setdefault(pair["position"] - pair["at"], []).append(pair)
    yield from (some for some in shifts.values() if enough(some))
    for run in (*_runs(pairs), *_runs([pair for pair in pairs if pair["item_slots"] == pair["slots"]])):
        whole = any(pair["at"] == 0 for pair in run) and any(pair["end"] == pair["size"] for pair in run)
        if whole or enough(run):
            yield run


def _values(pairs: list[dict]) -> set[tuple[str, str]]:
    """(item value, document value) of the slots, without their offsets."""
    slots = (both for pair in pairs for both in zip(pair["item_slots"], pair["slots"], strict=True))
    return {(item.partition("=")[2], doc.partition("=")[2]) for item, doc in slots}


def held_windows(pairs: list[dict], need: int) -> int:
    """Windows of the largest alignment of a document with an item that is consistent, or 0."""
    # A passage needs no more than to be there.
    best = len({pair["at"] for pair in pairs if pair["slots"] is None})
    pairs = [pair for pair in pairs if pair["slots"] is not None]
    places = lambda slots: [slot.partition("=")[0] for slot in slots]
    pairs = [pair for pair in pairs if places(pair["item_slots"]) == places(pair["slots"])]
    # A reading adds matches; it does not take away what matches without it.
    plain = [pair for pair in pairs if pair["item_plain"] and pair["plain"]]
    for some in (*_alignments(plain, need), *(_alignments(pairs, need) if len(plain) < len(pairs) else ())):
        values = _values(some)
        if len({item for item, _ in values}) == len(values):
            best = max(best, len({pair["at"] for pair in some}))
    return best


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, item_id, need, pairs -> the rows that hold the item, with their windows."""
    for batch in batches:
        needs, pairs = batch.column(3).to_pylist(), batch.column(4)
        windows = pa.array([held_windows(pairs[n].as_py(), need) for n, need in enumerate(needs)], pa.int64())
        rows = pa.RecordBatch.from_arrays([*batch.columns[:3], windows], names=["doc_id", "text_key", "item_id", "windows"])
        yield rows.filter(pa.compute.greater(windows, 0))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`doc_id, text_key, item_id, windows`: documents that hold an item's passage, stored.

    A row for each document and item of which enough windows match in one alignment, or run
    of windows, whose slots are consistent, or that has a passage of the item word for word.
    """
    # A row of the benchmark is an item by itself, also without an id.
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", F.coalesce("text", F.lit("")).alias("text"))
    templates = stored(
        items.mapInArrow(_benchmark_windows, TEMPLATES),
        "benchmark-windows",
    )
    kinds = templates.select("width", F.col("item_slots").isNull().alias("passage")).distinct().collect()
    widths, passages = (sorted(row["width"] for row in kinds if row["passage"] == passage) for passage in (False, True))
    hashes = templates.select("window").distinct()
    known = None
    if hashes.count() <= FILTER_WINDOWS:
        # The same cast as in the window rows; sorted as unsigned for the search.
        known = np.sort(np.array([row["window"] for row in hashes.collect()], np.int64).view(np.uint64))
    # An alignment is no longer than its item, where each token may take in another.
    reach = 2 * (templates.agg(F.max("size")).first()[0] or 0) + WINDOW
    # Rows equal in id and text are one, and a text is searched once per id.
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    found = texts.mapInArrow(_document_windows(widths, passages, known, reach), f"doc_id long, text_key long, {WINDOWS}")
    joined = found.distinct().join(templates, "window")
    sizes = templates.groupBy("item").agg(
        F.count_distinct(F.when(F.col("dense"), F.col("at"))).alias("all"),
        F.count_distinct(F.when(F.expr("dense and item_plain"), F.col("at"))).alias("plain_all"),
    )
    most = F.lit(MIN_WINDOWS)
    need = F.least(F.coalesce(F.nullif("plain_all", F.lit(0)), F.nullif("all", F.lit(0)), most), most)
    sizes = sizes.select("item", need.alias("need"))
    pair = F.struct(*PAIR)
    pairs = joined.groupBy("doc_id", "text_key", "item", "item_id").agg(F.collect_list(pair).alias("pairs")).join(sizes, "item")
    held = pairs.select("doc_id", "text_key", "item_id", "need", "pairs")
    # Others cannot be accepted.
    places = F.size(F.array_distinct(F.transform("pairs", lambda p: p["at"])))
    whole = F.exists("pairs", lambda p: p["at"] == 0) & F.exists("pairs", lambda p: p["end"] == p["size"])
    held = held.filter((places >= F.col("need")) | whole | F.exists("pairs", lambda p: p["slots"].isNull()))
    enough = held.mapInArrow(_judged, "doc_id long, text_key long, item_id long, windows long")
    best = enough.groupBy("doc_id", "text_key", "item_id").agg(F.max("windows").alias("windows"))
    return stored(best, "contaminated")


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document: `doc_id, contaminated, n_items, item_id, n_windows`.

    `item_id` is the item with most matching windows, the smallest of equals; items without an id count as one, whose `item_id` is null. A null text
    holds nothing; repeated rows are judged alike; other columns are ignored.
    """
    by_text = matches(docs, benchmark).groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n_items"),
        F.max_by("item_id", F.struct("windows", -F.col("item_id"))).alias("item_id"),
        F.max("windows").alias("n_windows"),
    )
    by_text = stored(by_text, "contaminated-texts")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.key") == F.col("m.text_key"))
    return rows.join(by_text.alias("m"), same, "left").select(
        "d.doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        "item_id",
        F.coalesce("n_windows", F.lit(0)).cast("long").alias("n_windows"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that hold no benchmark passage, with all their columns, whatever their names."""
    found = stored(matches(docs, benchmark).select("doc_id", "text_key").distinct(), "contaminated-texts")
    # The rows travel as one column, so that no name of theirs meets one of this module.
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_key(F.col("text")).alias("key"))
    same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.key") == F.col("m.text_key"))
    return rows.alias("d").join(found.alias("m"), same, "left_anti").select("row.*")
