"""The binned carry against a plain scan of the rows, for many bin sizes."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordered import Carry, carry


def make_rows(seed, n=400):
    rng = random.Random(seed)
    rows, ord_ = [], 0
    for _ in range(n):
        ord_ += rng.choice([1, 1, 1, 2, 40])
        # One key holds most of the rows.
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        sub = rng.choice([1, 1, 2, None])
        value = rng.choice([None, None, rng.randrange(100)])
        for ordinal in range(rng.choice([1, 1, 3])):
            rows.append((key, sub, ord_, ordinal, value))
    return rows


def expected(rows, index, by_sub, ahead, strict, total):
    key, sub, _, _, _ = rows[index]
    same = [
        i for i, r in enumerate(rows) if r[0] == key and (not by_sub or r[1] == sub)
    ]
    if ahead:
        seen = [i for i in same if (i > index if strict else i >= index)]
    else:
        seen = [i for i in same if (i < index if strict else i <= index)][::-1]
    values = [rows[i][4] for i in seen if rows[i][4] is not None]
    return sum(values) if total else (values[0] if values else None)


@pytest.mark.parametrize("bits,levels", [(0, 1), (3, 1), (3, 2), (6, 1), (18, 1), (2, 3)])
def test_carry_equals_scan(spark, bits, levels):
    rows = make_rows(bits * 10 + levels)
    rows.sort(key=lambda r: (r[2], r[3]))
    frame = spark.createDataFrame(rows, "k STRING, sub INT, ord BIGINT, ordinal INT, v BIGINT")
    kinds = [
        (by_sub, ahead, strict, total)
        for by_sub in (False, True)
        for ahead in (False, True)
        for strict in (False, True)
        for total in (False, True)
    ]
    values = [
        Carry(f"c{i}", F.col("v"), ("sub",) if by_sub else (), ahead, strict, total)
        for i, (by_sub, ahead, strict, total) in enumerate(kinds)
    ]
    found = {
        (r["ord"], r["ordinal"]): r
        for r in carry(frame, ["k"], ["ord", "ordinal"], values, bits, levels).collect()
    }
    assert len(found) == len(rows)
    for i, row in enumerate(rows):
        for j, kind in enumerate(kinds):
            assert found[row[2], row[3]][f"c{j}"] == expected(rows, i, *kind), (row, kind)


def test_one_shuffle_moves_the_rows(spark):
    """All values of a call share one exchange of the wide rows."""
    frame = spark.range(100).select(
        F.lit("k").alias("k"), (F.col("id") % 3).alias("sub"), F.col("id").alias("ord"), F.lit("wide").alias("payload")
    )
    out = carry(
        frame, ["k"], ["ord"],
        [Carry("a", F.col("ord")), Carry("b", F.col("ord"), ahead=True), Carry("c", F.col("ord"), by=("sub",))],
    )
    plan = out._jdf.queryExecution().sparkPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    # The first exchange below the outermost window is the only one that carries payload.
    top = executed.split("Union")[0]
    assert top.count("Exchange hashpartitioning") == 1
