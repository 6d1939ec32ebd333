import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridestrata.operators.profile import quantiles_by

SCHEMA = "bike string, day int, us long"
SHARES = [0.0, 0.25, 0.5, 0.99, 1.0]


def expected(rows):
    groups = {}
    for bike, day, us in rows:
        if us is not None:
            groups.setdefault((bike, day), []).append(us)
    return {
        key: (len(found), max(found), [float(q) for q in np.quantile(found, SHARES)])
        for key, found in groups.items()
    }


def found(df):
    rows = quantiles_by(df, ["bike", "day"], F.col("us"), SHARES).collect()
    assert len({(r.bike, r.day) for r in rows}) == len(rows)
    return {(r.bike, r.day): (r.n, r.largest, list(r.quantiles)) for r in rows}


@pytest.mark.parametrize("spread", [5, 60_000, 10**7, 10**12])
def test_groups_agree_with_a_plain_computation(spark, spread):
    """From one pass over the digits to three."""
    rng = random.Random(spread)
    rows = [("hot", 1, rng.randrange(-spread, spread)) for _ in range(700)]
    rows += [
        (rng.choice(["a", "", None]), rng.choice([1, 2, None]), rng.choice([None, 0, rng.randrange(-spread, spread)]))
        for _ in range(400)
    ]
    plain = expected(rows)
    result = found(spark.createDataFrame(rows, SCHEMA))
    assert result.keys() == plain.keys()
    for key, (n, largest, quantiles) in plain.items():
        assert result[key][:2] == (n, largest)
        assert result[key][2] == pytest.approx(quantiles, rel=1e-12, abs=1e-6)


def test_groups_without_values_and_empty_tables(spark):
    assert found(spark.createDataFrame([("a", 1, None)], SCHEMA)) == {}
    assert found(spark.createDataFrame([], SCHEMA)) == {}
    assert found(spark.createDataFrame([("a", 1, 7)] * 3, SCHEMA)) == {("a", 1): (3, 7, [7.0] * 5)}
