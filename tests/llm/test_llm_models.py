"""Operators that SQL cannot express, against brute force or held-out labels."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from comparison import TESTDATA

import corpus_pipeline
from tidemark.llm import backoff_model, decontaminate, mixing, pii, simhash, weak_labels
from tidemark.llm.common import read
from tidemark.llm.queries import QUERIES

SF = f"{TESTDATA}/sf0.001"
ODD = [None, "", " \n ", "one", "two words", "\u00a0", "A a A a", "x" * 3000, "the cat sat on the mat " * 300]


def frame(spark, texts, ids=None):
    rows = [(n if ids is None else ids[n], text, "clash") for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string")


def crc_fold(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 7


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_scores(rows, order, prior):
    count, tokens, types = Counter(), 0, set()
    for doc_id, text in rows:
        if doc_id is not None and crc_fold(doc_id) == 2:
            continue
        sequence = ["<s>", *words(text), "</s>"]
        tokens += len(sequence) - 1
        types |= set(sequence[1:])
        for size in range(1, order + 1):
            count.update(tuple(sequence[i : i + size]) for i in range(len(sequence) - size + 1))

    def probability(context, word):
        if not context:
            return (count[(word,)] + 1) / (tokens + len(types) + 1)
        seen = count[context]
        return (count[(*context, word)] + prior * probability(context[1:], word)) / (seen + prior)

    out = []
    for doc_id, text in rows:
        sequence = ["<s>", *words(text), "</s>"]
        score = sum(math.log10(probability(tuple(sequence[max(0, i - order + 1) : i]), sequence[i])) for i in range(1, len(sequence)))
        base = sum(math.log10(probability((), w)) for w in sequence[1:])
        out.append((doc_id, len(sequence) - 1, sum(count[(w,)] > 0 for w in sequence[1:]), tokens, base, score))
    return out, probability, types


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_the_smoothed_model(spark, order, monkeypatch):
    monkeypatch.setattr(backoff_model, "CHUNK_BYTES", 700)
    monkeypatch.setattr(backoff_model, "SHARD_BYTES", 900)
    dice = random.Random(order)
    texts = ODD + [" ".join(dice.choices(["a", "b", "C", "d,", "é"], k=dice.randint(0, 40))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(None, "a b c"), (3, "one")]
    got = backoff_model.score_texts(frame(spark, [t for _, t in rows], [i for i, _ in rows]), order, 5.0).collect()
    expected, probability, types = brute_scores(rows, order, 5.0)
    key = lambda row: (str(row[0]), *row[1:])
    ours = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=key)
    for mine, theirs in zip(ours, sorted(expected, key=key), strict=True):
        assert mine[:4] == theirs[:4] and mine[4:] == pytest.approx(theirs[4:], rel=1e-9)
    # All words and one unseen share the whole probability in any state.
    assert sum(probability(("a",), w) for w in [*types, "unseen"]) == pytest.approx(1) or order == 1
    assert backoff_model.score_texts(frame(spark, [])).count() == 0


def test_steps_together_and_alone_are_the_same(monkeypatch):
    dice = random.Random(1)
    texts = ODD + [" ".join(dice.choices("abcdefgh", k=dice.randint(0, 80))) for _ in range(90)]
    for order in (1, 2, 3, 4):
        grams = backoff_model.Grams(texts, order)
        counts = grams.counts(np.arange(len(texts)) % 3 > 0)
        model = backoff_model.Automaton(grams, counts, 900, 9, 3.0)
        scores = []
        for together in (1, 7, 10_000):
            monkeypatch.setattr(backoff_model, "TOGETHER", together)
            scores.append(model.scores(grams))
        assert np.allclose(scores[0], scores[1]) and np.allclose(scores[0], scores[2])
        empty = backoff_model.Grams([], order)
        assert len(backoff_model.Automaton(empty, empty.counts(np.zeros(0, bool)), 0, 0, 1.0).scores(empty)) == 0


def test_model_predicts_held_out_texts(spark):
    rows = QUERIES["op1_backoff_model"](spark, SF).filter("held_out").groupBy().sum("base_score", "score").first()
    assert rows[1] > rows[0] * 0.95


def brute_print(text):
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_classes(rows, prints):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, doc_id in enumerate(rows):
        ids[find(i)].append(doc_id)
    return [min((x for x in ids[find(i)] if x is not None), default=None) for i in range(len(rows))]


def test_classes_of_fingerprints(spark):
    docs = read(spark, SF, "documents", "doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs] + [(900 + n, t) for n, t in enumerate(ODD)] + [(None, "one"), (None, "solo null"), (900, None)]
    got = simhash.deduplicate(frame(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    prints = [brute_print(t) for _, t in rows]
    expected = brute_classes([i for i, _ in rows], prints)
    theirs = sorted((str(i), f"{p:016x}", str(c)) for (i, _), p, c in zip(rows, prints, expected, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == theirs
    assert simhash.deduplicate(frame(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [2, 10_000])
def test_every_pair_within_three_bits_is_connected(spark, limit):
    """Dense groups, chains and pairs at all distances, with crowded anchors or without."""
    dice = random.Random(limit)
    values = set()
    for _ in range(60):
        value = dice.getrandbits(64)
        values.add(value)
        for _ in range(6):
            for bit in dice.sample(range(64), dice.randint(1, 5)):
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(n, v) for n, v in enumerate(signed)], "doc_id long, fingerprint long")
    got = {r.fingerprint: r.component_id for r in simhash.classes(prints, limit=limit).collect()}
    assert [got[s] for s in signed] == brute_classes(list(range(len(values))), values)


def test_long_chains_reach_their_end(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(roots[n] == 0 for n in range(301)) and roots[1001] == 1000


def test_classifier_on_labels_it_never_saw(spark):
    sf = f"{TESTDATA}/sf0.01"
    judged = QUERIES["op6_quality_classifier"](spark, sf).withColumnRenamed("quality", "p")
    rows = judged.join(read(spark, sf, "labels", "doc_id", "quality"), "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(not r.kept for r in rows if r.quality == 0) > 0.9 * sum(r.quality == 0 for r in rows)


def test_classifier_on_awkward_rows(spark):
    docs = frame(spark, ODD + ["the cat of a house is in the garden. " * 9, "SPAM!! " * 80], None).withColumnRenamed("component_id", "kept")
    rows = weak_labels.judge(docs.union(docs)).collect()
    assert len(rows) == 2 * (len(ODD) + 2)
    assert all(r.quality == 0 and not r.kept for r in rows if not words(r.text))
    assert weak_labels.judge(docs.limit(0)).count() == 0


def test_label_model_finds_the_accuracies():
    dice = np.random.default_rng(3)
    good = dice.random(20_000) < 0.8
    patterns = Counter()
    for is_good in good:
        says_bad = dice.random(len(weak_labels.LABELLERS)) < (0.02 if is_good else 0.6)
        patterns["".join("b" if bad else "-" if dice.random() < 0.2 else "g" for bad in says_bad)] += 1
    model = weak_labels.estimate(patterns)
    assert abs(model.good - 0.8) < 0.03
    assert np.allclose(model.votes[:, 0, 1], 0.6, atol=0.06) and np.allclose(model.votes[:, 1, 1], 0.02, atol=0.02)


QUESTION = "Anna has 12 apples and buys 7 more at the market on Monday, then walks 3 km home and eats 7 of them."
OTHER = "Peter has 40 apples and buys 5 more at the market on Friday, then walks 9 miles home and eats 5 of them."
MIXED = "Peter has 40 apples and buys 5 more at the market on Friday, then walks 9 miles home and eats 6 of them."


def test_other_numbers_and_names_are_caught_if_consistent(spark):
    benchmark = spark.createDataFrame([(1, QUESTION), (2, None), (3, "two words")], "item_id long, text string")
    texts = ["Before. " + QUESTION + " After.", "So then " + OTHER, "So then " + MIXED, None, "", "Anna has 12 apples", QUESTION.replace(" ", "  \n")]
    docs = frame(spark, texts + texts[:1], [*range(len(texts)), None])
    got = decontaminate.judge(docs, benchmark).collect()
    assert {r.doc_id: r.contaminated for r in got} == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False, 6: True, None: True}
    assert len(got) == len(texts) + 1
    kept = decontaminate.clean(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5] and kept.columns == docs.columns
    assert decontaminate.judge(docs.limit(0), benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.judge(docs, benchmark.limit(0)).collect())


def contaminated(spark, items, texts):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.judge(frame(spark, texts), benchmark).collect()
    return [bool(r.contaminated) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_one_odd_slot_does_not_hide_a_passage(spark):
    same = "So then " + OTHER.replace("40", "5")  # 12 and 7 are both 5 there
    names = "Today Mary Ann paid 12 dollars for the new red book and later Mary Sue sold the same old book to her aunt."
    other = names.replace("Mary Ann", "Eve Poe").replace("Mary Sue", "Tom Poe")
    verbatim = QUESTION.replace("eats 7", "eats 6")
    assert contaminated(spark, [QUESTION, names], [verbatim, same, other, MIXED]) == [True, True, True, False]


def test_names_at_sentence_starts_are_placeholders(spark):
    short = "Anna has 12 apples. Bob buys 7 more. How many are left?"
    shop = "The shop sells 12 apples. Bob buys 7 more. Carl Orr counts what is left there."
    texts = ["Peter has 40 apples. Carl Poe buys 5 more. How many are left?", "So Peter has 40 apples. Then Carl buys 5 more. How many are left?"]
    texts += ["Today the shop sells 40 apples. Eve buys 5 more. Tom counts what is left there.", "Peter has 40 pears. Carl buys 5 more. How many are red?"]
    assert contaminated(spark, [short, shop], texts) == [True, True, True, False]
    many = decontaminate.Template(["Yes. No. " * 500], decontaminate.Lexicon())
    assert sum(len(part[0]) for part in many.windows(8)) > 500


def test_exact_copies_are_found_whatever_is_in_them(spark):
    items = ["What is 12 times 7?", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "we saw how Mary Ann Sue Lee sold apples and pears at home, then left the town for good"]
    texts = ["He asked: what is 12 times 7? No answer.", "so 2 3 4 5 6 7 8 9 10 11 12 13 more", "Anna saw how Mary Ann Sue Lee sold apples and pears at home yesterday", "What is 12 times 8?", "1 2 3 4 5 6 7 8 9 10 and 11 12 13 14"]
    title = "The Old Man And The Sea Of Green Hills And Far Away Lands"
    assert contaminated(spark, [*items, title], [*texts, "See " + title]) == [True, True, True, False, False, True]


def test_items_without_an_id_are_searched(spark):
    benchmark = spark.createDataFrame([(None, QUESTION), (None, "two words"), (4, "one")], "item_id long, text string")
    rows = decontaminate.judge(frame(spark, ["x " + QUESTION, "just two words", "none", None]), benchmark).orderBy("doc_id").collect()
    assert [(r.contaminated, r.n_items, r.item_id) for r in rows] == [(True, 1, None), (True, 1, None), (False, 0, None), (False, 0, None)]


def test_unfiltered_join_gives_the_same(spark, monkeypatch):
    def judged():
        rows = decontaminate.judge(read(spark, SF, "documents", "doc_id", "text"), read(spark, SF, "benchmark", "item_id", "text"))
        return sorted(map(repr, rows.collect()))

    filtered = judged()
    monkeypatch.setattr(decontaminate, "FILTER_WINDOWS", 0)
    assert judged() == filtered


def test_benchmark_passages_against_brute_force(spark):
    fold = lambda text: re.findall(r"[^\W_]+", text.lower())
    items = [fold(r.text) for r in read(spark, f"{TESTDATA}/sf0.01", "benchmark", "text").collect()]
    grams = {tuple(item[i : i + 11]) for item in items for i in range(len(item) - 10)}
    rows = read(spark, f"{TESTDATA}/sf0.01", "documents", "doc_id", "text").collect()
    held = {r.doc_id for r in rows if any(tuple(w[i : i + 11]) in grams for w in [fold(r.text)] for i in range(len(w) - 10))}
    found = QUERIES["op7_decontamination"](spark, f"{TESTDATA}/sf0.01").filter("contaminated")
    assert {r.doc_id for r in found.collect()} == held and held


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return (
            True,
            kind == 1 and all(int(part) <= 255 for part in value.split(".")),
            kind == 2 and 16 <= len(digits) <= 19 and pii.luhn(digits),
            kind == 3 and 8 <= len(digits) <= 15,
        )[kind]

    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if fits(k, m.group())]


def test_base_spans_are_those_of_the_patterns():
    dice = random.Random(11)
    parts = ["a", "Z9", ".", "..", "@", "@@", "-", "+", "+1", " ", "(", ")", "4111 1111 1111 1111", "255", "256", "007", "1.2.3.4", "é", "%", "_", "0", "\n", "4111111111111111", "555-0123"]
    for _ in range(20_000):
        text = "".join(dice.choices(parts, k=dice.randint(1, 14)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_scan_of_long_runs_is_linear():
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "1 " * 200_000, "+1" * 200_000, "a@" * 200_000):
        spans = pii.base_spans(run)
        pii.mentions(run, spans)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    texts = [f"please call number +1 (20{n}) 555-01{n}{n} today" for n in range(8)] + ["please call number 99-88-77-66 today"]
    texts += [f"item {n}{n}{n}{n}{n}{n} here" for n in range(4)] + [None, ""]
    rows = {r.doc_id: r for r in pii.find(frame(spark, texts)).collect()}
    assert rows[8].spans == "phone:19:30" and rows[8].n_phone == 0
    assert all(rows[n].spans == "" for n in range(9, len(texts)))
    redacted = {r.doc_id: r.text for r in pii.redact(frame(spark, texts)).collect()}
    assert redacted[8] == "please call number [PHONE] today" and redacted[13] is None
    assert pii.find(frame(spark, [])).count() == 0


def test_candidates_of_all_shapes_are_found(spark):
    texts = [f"call number +1 (20{n}) 555-01{n}{n} today" for n in range(9)] + [f"mail me under a{n}@b.org soon" for n in range(9)]
    odd = ["call number 020 7946 0018 today", "call number (212) 555-0123 today", "call number 4711 today", "mail me under jane at example dot org soon", "mail me under jane_doe soon"]
    odd += ["in 2019 there were 4711 of them", "we met at noon (212) 555-0123"]
    rows = {r.doc_id: r.spans for r in pii.find(frame(spark, texts + odd)).collect()}
    assert [rows[len(texts) + n] for n in range(7)] == ["phone:12:25", "phone:12:26", "phone:12:16", "email:14:37", "email:14:22", "", ""]
    assert pii.redact(frame(spark, texts + odd)).filter("doc_id = 19").first().text == "call number [PHONE] today"
    for run in ("a." * 200_000, "1 (" * 200_000, "a at " * 100_000, "@a " * 200_000, "a at b dot " * 50_000, " (" * 200_000):
        pii.mentions(run, [])


def test_found_identifiers_support_other_contexts(spark):
    texts = [f"number +1 (202) 555-{n:04}" for n in range(120)]
    texts += [f"{word} 99-88-77-{n:02}" for word in ("number", "dial") for n in range(30)] + ["dial 11-22-33-44"]
    texts += ["dial 020 7946 0018", "reach 11-22-33-55"]
    rows = {r.doc_id: r.spans for r in pii.find(frame(spark, texts)).collect()}
    assert rows[180] == "phone:5:16" and rows[181] == "phone:5:18" and rows[182] == ""


def test_base_columns_on_the_table_are_those_of_the_patterns(spark):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in read(spark, f"{TESTDATA}/sf0.01", "documents", "doc_id", "text").collect()}
    rows = QUERIES["op8_pii"](spark, f"{TESTDATA}/sf0.01").collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for row in rows:
        base = brute_spans(texts[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in range(4)]
        listed = [f"{pii.KINDS[kind]}:{start}:{end}" for kind, start, end in base]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(filter(None, listed)) <= set(row.spans.split(","))


def test_secrets_of_the_table_are_found_and_others_beside_them(spark):
    """All that `token` is set to in the table, and copies of some of it that no word announces."""
    rows = read(spark, f"{TESTDATA}/sf0.1", "documents", "doc_id", "text").filter("text LIKE '%token = \"%'").collect()
    texts = [r.text for r in rows]
    hidden = [re.sub('token = "([0-9a-f]{40})"', r'carry "\1" over', text) for text in texts[: len(texts) // 4]]
    found = {r.doc_id: r.spans for r in pii.find(frame(spark, texts + hidden)).collect()}
    for n, text in enumerate(texts + hidden):
        wanted = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer('"([0-9a-f]{40})"', text)}
        assert wanted and wanted <= set(found[n].split(","))
    clean = ["carry nothing over", 'a "quoted" word and "1234567890123" or "abcdefghijklmnop"', "token = none", "token: 12"]
    rows = {r.doc_id: r.spans for r in pii.find(frame(spark, texts + clean)).collect()}
    assert all(rows[len(texts) + n] == "" for n in range(len(clean)))


def test_a_planted_share_of_identifiers_is_recalled(spark):
    """Phone numbers without a plus and spelled-out addresses, in contexts that the base patterns have too."""
    dice = random.Random(9)
    leads = ["ring us on", "dial", "write to", "contact"]
    texts, hidden = [], 0
    for n in range(600):
        lead = leads[n % 4]
        word = dice.choice(["later", "soon", "please"])
        known = f"+1 (2{n % 90:02}) 555-{n:04}" if n % 4 < 2 else f"user{n}@mail{n % 7}.example.org"
        unseen = f"02{n % 90:02} 7946 {n:04}" if n % 4 < 2 else f"user{n} at mail{n % 7} dot example dot org"
        texts.append(f"{lead} {unseen if n % 5 == 0 else known} {word}")
        hidden += n % 5 == 0
    rows = pii.find(frame(spark, texts + [f"the {n} of {n * 7} parts" for n in range(200)])).collect()
    found = sum(bool(r.spans) and r.n_email + r.n_phone == 0 for r in rows if r.doc_id < 600)
    assert found >= 0.9 * hidden and not any(r.spans for r in rows if r.doc_id >= 600)


def test_graph_against_brute_force(spark):
    dice = random.Random(6)
    edges = set()
    for _ in range(900):
        kind = dice.choice([None, None, 0, 3, 4])
        shape = dice.choice(pii.SHAPES) if kind is None else None
        edges.add((dice.choice("abcdefgh"), dice.randrange(90), kind, shape))
    edges = sorted(edges, key=repr)
    frame_ = spark.createDataFrame(edges, "pattern string, instance long, kind int, shape int")
    got = {(r.shape, r.pattern, r.kind): r.score for r in pii.accepted_patterns(frame_, 3).collect()}

    def fits(shape, kind):
        if (shape == pii.MIXED) != (kind == pii.SECRET_KIND):
            return False
        return shape in (pii.TOKEN, pii.MIXED) or (shape == pii.ADDRESS) == (kind == 0)

    shapes_of, members = defaultdict(set), set()
    for pattern, instance, kind, shape in edges:
        shapes_of[pattern, instance] |= {shape} - {None}
        members |= {(one, pattern, instance) for one in (pii.SHAPES if kind is not None else [shape])}
    sizes = Counter((shape, pattern) for shape, pattern, _ in members)
    seeds = {(i, k) for _, i, k, _ in edges if k is not None}
    trust, done, turn = {seed: (1.0, True) for seed in seeds}, None, 0
    while True:
        turn += 1
        trusted, count = Counter(), Counter()
        extra = Counter()
        for (pattern, instance), shapes in shapes_of.items():
            for (other, kind), (value, sure) in trust.items():
                if other != instance:
                    continue
                for shape in pii.SHAPES if sure else shapes:
                    trusted[shape, pattern, kind] += value
                    count[shape, pattern, kind] += sure
                    extra[shape, pattern, kind] += value if value < 1 and shape not in shapes else 0
        scores = {
            (shape, pattern, kind): (value / (sizes[shape, pattern] + 1 + extra[shape, pattern, kind]), count[shape, pattern, kind])
            for (shape, pattern, kind), value in trusted.items()
            if sizes[shape, pattern] and fits(shape, kind)
        }
        accepted = {key: score for key, (score, sure) in scores.items() if score >= pii.MIN_SCORE and sure >= pii.MIN_SEEDS}
        if turn >= 3 and len(accepted) <= done:
            break
        done, found = len(accepted), {}
        for pattern, instance, kind, shape in edges:
            for (one, name, other), (score, _) in scores.items() if kind is None else ():
                if (one, name) == (shape, pattern) and (instance, other) not in seeds:
                    value, sure = found.get((instance, other), (0.0, False))
                    found[instance, other] = max(value, score * pii.DAMPING), sure or (one, name, other) in accepted
        trust = {**{seed: (1.0, True) for seed in seeds}, **found}
    assert got == pytest.approx(accepted)


def test_long_local_parts_are_taken_whole(spark):
    texts = [f"mail me under a{n}@b.org soon" for n in range(9)] + ["mail me under " + "x" * 100 + " at example dot org soon"]
    assert pii.redact(frame(spark, texts)).filter("doc_id = 9").first().text == "mail me under [EMAIL] soon"


def test_columns_of_any_name_pass_through_stages(spark):
    names = ["base", "spans", "mentions", "text_key", "_key", "key", "_root", "root", "row", "fingerprint", "component_id", "_row", "d", "a.b"]
    rows = [(n, f"call a{n}@b.org now " + QUESTION * (n == 3), *names) for n in range(4)] * 2
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    benchmark = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    left = decontaminate.clean(docs, benchmark)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [0, 0, 1, 1, 2, 2]
    masked = pii.redact(docs).collect()
    assert len(masked) == 8 and all("[EMAIL]" in r.text and list(r)[2:] == names for r in masked)
    one = simhash.one_per_class(docs)
    assert one.columns == docs.columns and all(list(r)[2:] == names for r in one.collect())


def test_mixture_against_brute_force(spark):
    dice = random.Random(2)
    rows = [(n, " ".join(["w"] * dice.randint(0, 30)), dice.choice(["a"] * 40 + ["b"] * 8 + ["c", None])) for n in range(1500)]
    rows += rows[:3] + [(None, "w w", "a"), (2000, None, "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, epoch int")
    for target in (mixing.Target(), mixing.Target(0.99, None), mixing.Target(None, 1.5, 40_000), mixing.Target(1.0, None, 5_000)):
        used = mixing.mix(docs, target, block_rows=64).collect()
        size = Counter()
        for _, text, source in rows:
            size[source] += len((text or "").split())
        budget = target.budget or sum(size.values())
        plan = {r.source: r for r in mixing.weights(docs, target).collect()}
        share = [r.weight for r in plan.values()]
        assert sum(share) == pytest.approx(1)
        if target.entropy and target.repeats is None:
            assert -sum(w * math.log(w) for w in share) >= target.entropy * math.log(len(share)) - 1e-6
        if target.repeats:
            assert all(r.budget <= target.repeats * size[s] + 1 for s, r in plan.items()) or sum(size.values()) * target.repeats < budget
        spent, uses = Counter(), defaultdict(Counter)
        for use in used:
            spent[use.source] += use.n_tokens
            uses[use.source][use.epoch] += use.n_tokens
            assert 0 <= use.place < 1
        for source, row in plan.items():
            assert row.budget <= spent[source] < row.budget + 30 or row.budget == 0
            whole, passes = row.budget // size[source], uses[source]
            assert all(passes[epoch] == size[source] for epoch in range(whole))
        assert abs(sum(r.budget for r in plan.values()) - budget) <= len(plan)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    model = weak_labels.fit(docs)
    kept = stages[names[0]](spark, docs, SF)
    good = [r for r in docs.collect() if model.probability(r.text) >= 0.5]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in good}
    single = stages[names[1]](spark, kept, SF).collect()
    classes = brute_classes([r.doc_id for r in good], [brute_print(r.text) for r in good])
    assert sorted(r.doc_id for r in single) == sorted(set(classes))
    clean = stages[names[2]](spark, spark.createDataFrame(single, docs.schema), SF)
    fold = lambda text: re.findall(r"[^\W_]+", text.lower())
    items = [fold(r.text) for r in read(spark, SF, "benchmark", "text").collect()]
    grams = {tuple(item[i : i + 11]) for item in items for i in range(len(item) - 10)}
    held = {r.doc_id for r in single if any(tuple(w[i : i + 11]) in grams for w in [fold(r.text)] for i in range(len(w) - 10))}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single} - held
    masked = stages[names[3]](spark, clean, SF).collect()
    assert not any(brute_spans(r.text) for r in masked) and all(r.n_chars == len(r.text) for r in masked)
    mixed = QUERIES["pipeline"](spark, SF)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in masked}


def test_pipeline_on_awkward_rows(spark):
    texts = ODD + ["the cat of a house is in the garden of it. " * 9] * 3
    rows = [(n if n != 4 else None, t, None, None if n % 2 else "s", None) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("kept", docs_flag())
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() >= 0
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0


def docs_flag():
    from pyspark.sql import functions as F

    return F.lit("clash")


def windows_of(texts, benchmark):
    """Window rows of texts and of items, as the tasks make them."""
    import pyarrow as pa

    numbers = list(range(len(benchmark)))
    items = pa.RecordBatch.from_pydict({"item": numbers, "item_id": numbers, "text": benchmark})
    templates = [row for batch in decontaminate._benchmark_windows([items]) for row in batch.to_pylist()]
    widths, passages = (sorted({r["width"] for r in templates if (r["item_slots"] is None) == p}) for p in (False, True))
    known = np.sort(np.unique(np.array([r["window"] for r in templates], np.int64)).view(np.uint64))
    reach = 2 * max(r["size"] for r in templates) + decontaminate.WINDOW
    docs = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text_key": [0] * len(texts), "text": texts})
    made = decontaminate._document_windows(widths, passages, known, reach)([docs])
    return [row for batch in made for row in batch.to_pylist()], templates


def held(texts, benchmark):
    """Pairs that are collected, and the largest consistent alignment by document and item."""
    windows, templates = windows_of(texts, benchmark)
    by_window, groups = defaultdict(list), defaultdict(list)
    for row in templates:
        by_window[row["window"]].append(row)
    for row in windows:
        for item in by_window[row["window"]]:
            groups[row["doc_id"], item["item"]].append({name: (row if name in row else item)[name] for name in decontaminate.PAIR})
    found = {key: decontaminate.held_windows(pairs, 4) for key, pairs in groups.items()}
    return sum(map(len, groups.values())), {key: windows for key, windows in found.items() if windows}


def test_a_text_that_repeats_itself_gives_few_pairs():
    pairs, found = held(["ha " * 100_000], ["ha " * 40])
    assert pairs < 10_000 and found == {(0, 0): 33}
    assert held(["Ann has 3 big red dogs now. " * 20_000], ["Ann has 3 big red dogs now. " * 5])[0] < 10_000


def test_windows_left_out_change_no_alignment(monkeypatch):
    dice = random.Random(4)
    items = ["ha " * 14, QUESTION, "Ann has 3 big red dogs now. Bob has 4 big red cats now.", "the cat sat on the mat and " * 3]
    pieces = [*items, "ha " * 30, "Eve has 5 big red dogs now. Joe has 6 big red cats now.", "x y z", "ha ha", "7", "the cat sat on the mat and"]
    pieces += ["Eve has 5 big red dogs now. Eve has 6 big red cats now."]
    texts = [" ".join([dice.choice(pieces) for _ in range(dice.randint(1, 4))] * dice.choice([1, 1, 12])) for _ in range(120)]
    pairs, found = held(texts, items)
    monkeypatch.setattr(decontaminate.Template, "first_of_kind", lambda self, places, *_: np.arange(len(places)))
    more, whole = held(texts, items)
    assert found == whole and len(found) > 100 and pairs < more / 2


def test_label_model_is_that_of_document_by_document_estimation():
    """Expectation-maximisation in plain loops over documents instead of counted patterns."""
    dice = random.Random(12)
    rows = []
    for _ in range(400):
        good = dice.random() < 0.8
        rows.append("".join(dice.choice("g" * (8 if good else 3) + "b" * (1 if good else 6) + "--") for _ in weak_labels.LABELLERS))
    rounds = 7
    start = {"bad": {"g": 0.6, "b": 0.4}, "good": {"g": 0.99, "b": 0.01}}
    share, table = 0.85, [start] * len(weak_labels.LABELLERS)
    kept = max(1.0, len(rows) * 0.002)

    def posterior(row):
        likely = {"bad": 1 - share, "good": share}
        for votes, vote in zip(table, row, strict=True):
            for cls in likely if vote != "-" else ():
                likely[cls] *= votes[cls][vote]
        return likely["good"] / (likely["good"] + likely["bad"])

    for _ in range(rounds):
        is_good = [posterior(row) for row in rows]
        sums = [{cls: {v: start[cls][v] * kept for v in "gb"} for cls in start} for _ in table]
        for row, chance in zip(rows, is_good, strict=True):
            for place, vote in enumerate(row):
                if vote != "-":
                    sums[place]["good"][vote] += chance
                    sums[place]["bad"][vote] += 1 - chance
        share = (sum(is_good) + 0.85 * kept) / (len(rows) + kept)
        table = [{cls: {v: one[cls][v] / sum(one[cls].values()) for v in "gb"} for cls in one} for one in sums]
    model = weak_labels.estimate(Counter(rows), rounds)
    assert model.good == pytest.approx(share)
    for place, votes in enumerate(table):
        expected = [[votes[cls][v] for v in "gb"] for cls in ("bad", "good")]
        assert np.allclose(model.votes[place], expected)
    for row in rows[:50]:
        assert model.posterior(row) == pytest.approx(posterior(row))


def test_scorer_is_that_of_plain_gradient_steps(monkeypatch):
    monkeypatch.setattr(weak_labels, "STEPS", 25)
    dice = random.Random(3)
    rows = []
    for _ in range(40):
        buckets = [dice.randrange(weak_labels.BUCKETS) if dice.random() < 0.2 else dice.randrange(9) for _ in range(dice.randint(1, 8))]
        rows.append((buckets, [dice.random() for _ in buckets], dice.random()))
    weights = defaultdict(float)
    for _ in range(25):
        slope = defaultdict(float)
        for buckets, values, good in rows:
            guess = 1 / (1 + math.exp(-sum(weights[b] * v for b, v in zip(buckets, values, strict=True))))
            for b, v in zip(buckets, values, strict=True):
                slope[b] += (guess - good) / len(rows) * v
        for b in set(weights) | set(slope):
            weights[b] -= weak_labels.RATE * (slope[b] + weak_labels.RIDGE * weights[b])
    got = weak_labels.train(rows)
    assert np.count_nonzero(got) <= len(weights) and all(got[b] == pytest.approx(w, abs=1e-12) for b, w in weights.items())


def test_quality_on_the_table_is_that_of_the_fitted_parts(spark):
    """Each document by itself, with the model that the whole table gives."""
    docs = read(spark, SF, "documents", "doc_id", "text")
    model = weak_labels.fit(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    patterns = Counter(weak_labels.votes(weak_labels.parse(text)) for text in texts.values())
    again = weak_labels.estimate(patterns)
    assert model.labels.good == pytest.approx(again.good) and np.allclose(model.labels.votes, again.votes)
    for row in weak_labels.judge(docs, model).collect():
        buckets, values = weak_labels.features(weak_labels.parse(texts[row.doc_id]))
        total = sum(model.weights[b] * v for b, v in zip(buckets, values, strict=True))
        expected = 1 / (1 + math.exp(-total)) if (texts[row.doc_id] or "").split() else 0.0
        assert row.quality == pytest.approx(expected) and row.kept == (row.quality >= weak_labels.THRESHOLD)
