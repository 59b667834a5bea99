"""Audits over bitmaps against the same questions asked of sets."""

import random

import pytest

from tidemark.operators import bitmaps
from tidemark.operators.bitmaps import BLOCK

ROW = "kafka_topic string, kafka_partition int, kafka_offset long"
TOP = (1 << 63) - 1


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def drawn(seed, extra=()):
    dice = random.Random(seed)
    near = [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK - 1, 5 * BLOCK + 7, TOP - 1, TOP]
    rows = {(dice.choice("ab"), dice.choice([0, 3]), dice.choice([*near, dice.randrange(4 * BLOCK)])) for _ in range(300)}
    return sorted(rows | set(extra))


def runs(rows):
    out = []
    for key in sorted({r[:2] for r in rows}):
        held = sorted(r[2] for r in rows if r[:2] == key)
        out += [(*key, a + 1, b - 1, b - a - 1) for a, b in zip(held, held[1:], strict=False) if b - a > 1]
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_gaps(spark, seed):
    rows = drawn(seed)
    got = bitmaps.missing_runs(bitmaps.offset_bitmaps(frame(spark, rows).repartition(5)))
    assert sorted(map(tuple, got.collect())) == runs(rows)


def test_gaps_of_few(spark):
    for rows in ([], [("a", 0, 5)], [("a", 0, 0), ("a", 0, 1)], [("a", 0, BLOCK - 1), ("a", 0, BLOCK)]):
        assert bitmaps.missing_runs(bitmaps.offset_bitmaps(frame(spark, rows))).count() == 0


def test_differences_both_ways(spark):
    a, b = drawn(1), drawn(2, drawn(1)[::3])
    got = bitmaps.differences(*[bitmaps.offset_bitmaps(frame(spark, rows)) for rows in (a, b)])
    expected = [(*r, "log_only") for r in set(a) - set(b)] + [(*r, "staging_only") for r in set(b) - set(a)]
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    same = bitmaps.offset_bitmaps(frame(spark, a))
    assert bitmaps.differences(same, same).count() == 0
    assert bitmaps.differences(same, same.limit(0)).count() == len(a)


def test_unsafe_commits(spark):
    log, staged = drawn(3), drawn(4)
    commits = [("a", 0, BLOCK + 5), ("a", 3, 3 * BLOCK), ("b", 0, None)]
    frontier = spark.createDataFrame(commits, "kafka_topic string, kafka_partition int, commit_offset long")
    got = bitmaps.unsafe_commits(*[bitmaps.offset_bitmaps(frame(spark, rows)) for rows in (log, staged)], frontier)
    below = {(t, p): c for t, p, c in commits if c is not None}
    expected = [r for r in set(log) - set(staged) if r[2] < below.get(r[:2], 0)]
    assert expected and sorted(map(tuple, got.collect())) == sorted(expected)


def test_repeats_over_copies(spark):
    rows = [(*r, copy) for copy in range(4) for r in drawn(copy)]
    copies = spark.createDataFrame(rows, ROW + ", copy int")
    got = bitmaps.repeated(bitmaps.offset_bitmaps(copies, "copy"))
    times = {}
    for row in rows:
        times[row[:3]] = times.get(row[:3], 0) + 1
    assert sorted(map(tuple, got.collect())) == sorted((*r, n) for r, n in times.items() if n > 1)


def test_what_is_exchanged_is_a_row_per_block(spark):
    rows = spark.range(6 * BLOCK).selectExpr("'a' AS kafka_topic", "0 AS kafka_partition", "id AS kafka_offset")
    held = bitmaps.offset_bitmaps(rows)
    assert held.count() == 6 and {len(r.bits) for r in held.collect()} == {BLOCK // 8}
