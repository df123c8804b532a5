import random

import pytest
from pyspark.sql import functions as F

from tallyguard.operators.ordered import find_hot, running
from tallyguard.params import ScaleParams


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; one key holds half of them, and each arrival is unique."""
    draw = random.Random(7)
    rows = [
        ("hot" if draw.random() < 0.5 else f"k{draw.randrange(40)}", n, draw.randrange(-50, 50))
        for n in range(900)
    ]
    return rows, spark.createDataFrame(rows, "key string, n long, v long").cache()


def brute_force(rows):
    state, result = {}, set()
    for key, n, v in sorted(rows, key=lambda r: r[1]):
        total, top, last = state.get(key, (0, None, None))
        result.add((key, n, total, top, last))
        state[key] = (total + v, v if top is None else max(top, v), v)
    return result


@pytest.mark.parametrize("chunk_rows", [10, 64, 10_000])
def test_running_values_do_not_depend_on_chunks(skewed, chunk_rows):
    rows, df = skewed
    scale = ScaleParams(chunk_rows=chunk_rows)
    got = running(
        df,
        ["key"],
        "n",
        sums={"total": F.col("v")},
        maxima={"top": F.col("v")},
        last={"before": F.col("v")},
        scale=scale,
    )
    assert {tuple(r)[:2] + tuple(r)[3:] for r in got.collect()} == brute_force(rows)


def test_every_large_key_counts_as_hot(skewed, spark):
    _, df = skewed
    hot = find_hot(df, ["key"], ScaleParams(chunk_rows=100))
    assert [r.key for r in hot.collect()] == ["hot"]
    assert find_hot(df, ["key"], ScaleParams(chunk_rows=600)) is None
    even = spark.range(9000).select((F.col("id") % 300).alias("key"))
    assert find_hot(even, ["key"], ScaleParams(chunk_rows=29)).count() == 300


def test_chunks_bound_the_rows_of_a_task(skewed):
    _, df = skewed
    scale = ScaleParams(chunk_rows=50)
    got = running(df, ["key"], "n", sums={"total": F.lit(1)}, scale=scale)
    plan = got._jdf.queryExecution().toString()
    assert "hashpartitioning(key" in plan and "_chunk" in plan
