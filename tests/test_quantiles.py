"""Histogram-based exact percentiles equal Spark's ``percentile`` aggregate,
with a hot value, uneven groups and single-row groups."""

import random

import pytest
from pyspark.sql import functions as F

from cinelake.functions.quantiles import exact_percentiles

PS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [(g, float(rnd.randint(0, 300))) for g in range(6) for _ in range(rnd.randint(1, 400))]
    rows += [(2, 42.0)] * 3000            # one hot value in one group
    rows += [(9, 1.5)]                    # single-row group
    return spark.createDataFrame(rows, "g long, x double")


def _expected(df, group):
    aggs = [F.percentile("x", p).alias(k) for k, p in PS.items()]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


@pytest.mark.parametrize("group", [[], ["g"]])
def test_matches_percentile(data, group):
    got = {tuple(r[c] for c in group): [round(r[k], 9) for k in PS]
           for r in exact_percentiles(data, "x", PS, group or None).collect()}
    want = {tuple(r[c] for c in group): [round(r[k], 9) for k in PS] for r in _expected(data, group).collect()}
    assert got == want
