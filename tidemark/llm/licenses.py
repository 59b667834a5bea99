"""License scans: an exact set-similarity join of texts, and of blocks in them, with notice templates.

Texts are split into words once; what is kept of them are the places of template words, in a
stored table. From it come the corpus-wide counts that order the words, the base phrases, and
the join: a text and a template meet on a word of the template's prefix (its rarest words, as many
as may be missing and one more) and pass the length and positional filters on what the whole text
holds. Then all blocks of such a text are verified: a block is any run of words of the template's
length divided by the threshold, so a copy lies whole in a block wherever it stands, with some
words put in between. The words of a block are bits of a mask that slides along the places, so the
cost follows the number of places. Texts are compared by row, so no hot word or source gathers in
one task.

Where a copy of another license's template would meet a template too, the words that tell the two
apart must be in the block.
"""

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, lower_ascii, once, stored

CONTAINMENT = 0.8
# Words per mask, and the width that places are stretched to, so that blocks of all templates are as wide.
MASK_BITS = 62
STRETCH = 1 << 32
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases with their labels, and notices that commonly announce a license.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str

    @property
    def words(self) -> list[str]:
        return sorted(set(self.text.split()))


TEMPLATES = (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template("mpl", "subject to the terms of the mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("proprietary", "confidential and proprietary all rights reserved"),
)


def needed(template: Template, containment: float) -> int:
    """Words of the template that a block must hold."""
    return max(1, ceil(round(containment * len(template.words), 9)))


def block_length(template: Template, containment: float) -> int:
    return max(1, ceil(round(len(template.text.split()) / containment, 9)))


def telling(template: Template, templates: tuple[Template, ...], containment: float) -> list[str]:
    """Words that a block must hold because without them it may be a copy of another label's template."""
    own = set(template.words)
    alike = [set(t.words) for t in templates if t.label != template.label and len(own & set(t.words)) >= needed(template, containment)]
    return sorted(set().union(*[own - other for other in alike]))


def places(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """`doc_id, n_words`, and the positions and lower-case forms of vocabulary words of each row."""
    words = F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), BETWEEN_WORDS), "")
    split = once(docs.select("doc_id", "text"), words=words).drop("text")
    # lower() is quick but folds letters beyond A-Z too; the second test is exact.
    near = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1, F.lit(1)), lambda i: F.lower(F.get("words", i)).isin(vocabulary)
    )
    found = once(split, near=F.when(F.size("words") > 0, near).otherwise(F.array().cast("array<int>")))
    exact = once(found, at=F.filter("near", lambda i: lower_ascii(F.get("words", i)).isin(vocabulary)))
    return exact.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "at",
        F.transform("at", lambda i: F.translate(F.get("words", i), UPPER, LOWER)).alias("word"),
    )


def _phrase_places() -> tuple[Column, Column]:
    """First positions of all base phrases, and their labels, with repeats."""

    def places_of(parts: list[str]) -> Column:
        def here(_, k):
            same = F.get("word", k) == parts[0]
            for step, part in enumerate(parts[1:], 1):
                same = same & (F.get("word", k + step) == part) & (F.get("at", k + step) == F.get("at", k) + step)
            return F.coalesce(same, F.lit(False))

        return F.filter("at", here)

    starts, labels = [], []
    for phrase, label in PHRASES.items():
        hits = places_of(phrase.split())
        starts.append(hits)
        labels.append(F.when(F.size(hits) > 0, F.lit(label)))
    return F.concat(*starts), F.array_compact(F.array(*labels))


def _candidates(table: DataFrame, templates: tuple[Template, ...], containment: float) -> DataFrame:
    """`row, template`: texts that hold as many of the template's words as a block must."""
    spark = table.sparkSession
    vocabulary = sorted({word for template in templates for word in template.words})
    # One count per template word: as many rows as the templates have words.
    counts = table.select(F.explode("word").alias("word")).groupBy("word").count().collect()
    frequency = dict.fromkeys(vocabulary, 0) | {row["word"]: row["count"] for row in counts if row["word"] in vocabulary}
    rank = {word: place for place, word in enumerate(sorted(vocabulary, key=lambda word: (frequency[word], word)))}
    prefixes = []
    for number, template in enumerate(templates):
        ordered, least = sorted(rank[word] for word in template.words), needed(template, containment)
        prefixes += [(ordered[i], number, i, ordered, least) for i in range(len(ordered) - least + 1)]
    prefix = spark.createDataFrame(prefixes, "token int, template int, i int, tokens array<int>, least int")
    rare = sorted({row[0] for row in prefixes})
    ranks = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair])
    # The distinct template words of a text in the global order: at most as many as the templates have.
    known = F.array_compact(F.transform(F.array_distinct("word"), lambda word: F.try_element_at(ranks, word)))
    held = once(table.select("row", "word"), held=F.sort_array(known)).select("row", "held")
    probes = held.filter(F.arrays_overlap("held", F.array(*[F.lit(token) for token in rare])))
    met = probes.select("*", F.posexplode("held").alias("j", "token")).join(prefix, "token")
    # The rarest shared word bounds the whole overlap by what stands after it on either side.
    rarest = met.filter(F.size("held") >= F.col("least")).groupBy("row", "template")
    nearest = rarest.agg(F.min_by(F.struct("i", "j", "tokens", "least", "held"), "i").alias("c")).select("row", "template", "c.*")
    bounded = nearest.filter(1 + F.least(F.size("tokens") - F.col("i") - 1, F.size("held") - F.col("j") - 1) >= F.col("least"))
    return bounded.filter(F.size(F.array_intersect("held", "tokens")) >= F.col("least")).select("row", "template")


def _matches(table: DataFrame, templates: tuple[Template, ...], containment: float) -> DataFrame:
    """`row, label, score` of texts with a block that meets a template's threshold, by the best block."""
    spark = table.sparkSession
    masks = range(max((ceil(len(t.words) / MASK_BITS) for t in templates), default=1))
    bits, rules = [], []
    for number, template in enumerate(templates):
        words, must = template.words, telling(template, templates, containment)
        # Stretched so that places less than a block apart, and no others, differ by at most STRETCH.
        reach = block_length(template, containment) - 1
        stretch = STRETCH // reach if reach else STRETCH + 1
        place = {word: divmod(at, MASK_BITS) for at, word in enumerate(words)}
        bits += [(number, word, stretch, *[1 << at if mask == m else 0 for m in masks]) for word, (mask, at) in place.items()]
        musts = [sum(1 << place[word][1] for word in must if place[word][0] == m) for m in masks]
        rules.append((number, template.label, len(words), needed(template, containment), *musts))
    named = [f"mask{m}" for m in masks]
    bit = spark.createDataFrame(bits, "template int, word string, stretch long, " + ", ".join(f"{m} long" for m in named))
    rule = spark.createDataFrame(
        rules, "template int, label string, words int, least int, " + ", ".join(f"must{m} long" for m in masks)
    )
    chosen = table.select("row", "at", "word").join(_candidates(table, templates, containment), "row")
    found = chosen.select("row", "template", F.inline(F.arrays_zip("at", "word"))).join(bit, ["template", "word"])
    block = W.partitionBy("row", "template").orderBy(F.col("at") * F.col("stretch")).rangeBetween(0, STRETCH)
    sliding = found.select("row", "template", *[F.bit_or(m).over(block).alias(m) for m in named])
    judged = sliding.join(rule, "template").withColumn("shared", sum((F.bit_count(m) for m in named), F.lit(0)))
    for m in masks:
        judged = judged.filter(F.col(f"mask{m}").bitwiseAND(F.col(f"must{m}")) == F.col(f"must{m}"))
    best = judged.filter("shared >= least").groupBy("row", "label")
    return best.agg(F.max((F.col("shared") / F.col("words")).cast("double")).alias("score"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """A row per document: `doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`.

    `n_base` counts base phrases, `first_word` and `last_word` are their smallest and largest
    start, null without any. `score` is 1 with a base phrase, else the largest containment
    found, else 0. A null text is empty; repeated rows are scanned one by one.
    """
    vocabulary = {word for template in templates for word in template.words}
    vocabulary |= {word for phrase in PHRASES for word in phrase.split()}
    placed = places(docs, sorted(vocabulary)).withColumn("row", F.monotonically_increasing_id())
    table = stored(placed, "license-places")
    found = (
        _matches(table, templates, containment)
        .groupBy("row")
        .agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    )
    starts, labels = _phrase_places()
    based = once(table.select("row", "doc_id", "n_words", "at", "word"), starts=starts, phrases=labels).drop("at", "word")
    joined = based.join(found, "row", "left")
    none = F.array().cast("array<string>")
    every = F.array_union("phrases", F.coalesce("found", none))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct("phrases")), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
