import random

import pytest

from tidemark.operators.ordered import with_position, with_previous


@pytest.mark.parametrize("block", [1, 2, 8, 10, 1 << 16])
def test_previous_is_a_plain_lag(spark, block):
    rng = random.Random(block)
    keyed = {k: sorted(rng.sample(range(1000), n)) for k, n in {"hot": 400, "cold": 3, "one": 1}.items()}
    rows = [(k, o, o * 10) for k, offsets in keyed.items() for o in offsets]
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint")
    found = with_previous(df, ["k"], "o", ["o", "v"], block)
    got = {(r.k, r.o): None if r.previous is None else tuple(r.previous) for r in found.collect()}
    expected = {}
    for k, offsets in keyed.items():
        for before, o in zip([None, *offsets], offsets, strict=False):
            expected[k, o] = None if before is None else (before, before * 10)
    assert got == expected


@pytest.mark.parametrize("block", [1, 7, 16, 1 << 16])
def test_position_is_a_plain_row_number(spark, block):
    rng = random.Random(block)
    keyed = {k: sorted(rng.sample(range(2000), n)) for k, n in {"hot": 700, "cold": 5}.items()}
    rows = [(k, o) for k, offsets in keyed.items() for o in offsets]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, o bigint")
    got = {(r.k, r.o): r.n for r in with_position(df, ["k"], "o", "n", block).collect()}
    assert got == {(k, o): n for k, offsets in keyed.items() for n, o in enumerate(offsets)}


def test_blocks_at_the_top_of_the_offset_space(spark):
    top = 2**63 - 1
    offsets = [0, 2**53, 2**53 + 1, top - 200, top - 1, top]
    df = spark.createDataFrame([("k", o) for o in offsets], "k string, o bigint")
    found = with_previous(df, ["k"], "o", ["o"], 3).orderBy("o").collect()
    assert [None if r.previous is None else r.previous.o for r in found] == [None, *offsets[:-1]]
