import random
from decimal import Decimal

import numpy as np
import pytest

from teletally.operators.quantiles import _narrowed, exact_quantiles

FRACTIONS = (0.0, 1 / 3, 0.5, 2 / 3, 0.99, 1.0)


def check(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(5)
    found = exact_quantiles(df, "v", FRACTIONS).first()
    numbers = np.array([float(v) for v in values if v is not None])
    assert list(found) == pytest.approx([float(np.quantile(numbers, f)) for f in FRACTIONS], rel=1e-12)


def test_spread_values(spark):
    rng = random.Random(1)
    check(spark, [rng.randrange(-(10**15), 10**15) for _ in range(501)] + [None, None], "long")


def test_heavy_value(spark):
    rng = random.Random(2)
    check(spark, [7] * 400 + [rng.randrange(0, 20) for _ in range(300)] + [10**17], "long")


def test_small_and_single(spark):
    check(spark, [3], "long")
    check(spark, [3, 4], "int")
    check(spark, [-1, -1, 2], "long")


def test_decimals(spark):
    rng = random.Random(3)
    values = [Decimal(rng.randrange(0, 10**9)) / 100 for _ in range(200)]
    check(spark, values, "decimal(28,2)")


@pytest.mark.parametrize("bins", [2, 7, 100])
def test_few_counts_per_pass(spark, bins):
    rng = random.Random(4)
    values = [-(2**63), 2**63 - 1, *[int(rng.gauss(0, 1) * 10 ** rng.randrange(1, 15)) for _ in range(300)]]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = exact_quantiles(df, "v", FRACTIONS, bins=bins).first()
    assert list(found) == list(exact_quantiles(df, "v", FRACTIONS).first())
    assert list(found) == pytest.approx([float(np.quantile(np.array(values, dtype=float), f)) for f in FRACTIONS], rel=1e-9)


def test_brackets_that_miss(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for bracket in ((0, 10), (900, 999), (500, 500), (0, 999)):
        brackets = {400: bracket}
        while brackets[400][0] != brackets[400][1] or brackets[400] == (500, 500):
            brackets = _narrowed(df, brackets, (0, 999), 16)
        assert brackets[400] == (400, 400)


def test_empty(spark):
    df = spark.createDataFrame([], "v long")
    assert list(exact_quantiles(df, "v", (0.5,)).first()) == [None]


def test_doubles_are_refused(spark):
    with pytest.raises(TypeError):
        exact_quantiles(spark.createDataFrame([(1.0,)], "v double"), "v", (0.5,))
