"""Randomised checks against independent implementations (pandas, numpy, Decimal)."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from faultline.functions.numeric import exact_percent
from faultline.operators.ranking import rank_rows
from faultline.operators.text import histogram_equal_width

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60),
       other=st.lists(st.integers(0, 2), min_size=60, max_size=60),
       desc=st.booleans(), parts=st.integers(1, 6))
def test_rank_rows_equals_pandas_min_rank(spark, values, other, desc, parts):
    rows = [(i, v, other[i]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    got = {r.id: r["rank"] for r in rank_rows(df, [("a", not desc), ("b", True)], partitions=parts).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "a", "b"])
    # SQL order: ASC NULLS FIRST / DESC NULLS LAST -> a sort key where NULL sorts first ascending
    key_a = pdf["a"].map(lambda v: (-1e9 if v is None or pd.isna(v) else v))
    if desc:
        key_a = pdf["a"].map(lambda v: (1e9 if v is None or pd.isna(v) else -v))
    order = pd.Series(list(zip(key_a, pdf["b"])))
    want = order.rank(method="min").astype(int)
    assert [got[i] for i in pdf["id"]] == list(want)


@SETTINGS
@given(values=st.lists(st.integers(0, 10_000), min_size=1, max_size=80), bins=st.integers(1, 12))
def test_histogram_counts_equal_numpy(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = [r["count"] for r in histogram_equal_width(df, "x", bins).collect()]
    if min(values) == max(values):
        assert got == [len(values)] + [0] * (bins - 1)
    else:
        want, _ = np.histogram(np.array(values), bins=bins)
        assert got == list(want)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=30),
       decimals=st.integers(0, 3))
def test_exact_percent_equals_decimal(spark, pairs, decimals):
    pairs = [(min(c, t), t) for c, t in pairs]
    df = spark.createDataFrame(pairs, "c long, t long")
    got = [r[0] for r in df.select(exact_percent("c", "t", decimals)).collect()]
    q = Decimal(1).scaleb(-decimals)
    want = [float((Decimal(c) * 100 / Decimal(t)).quantize(q, rounding=ROUND_HALF_UP)) for c, t in pairs]
    assert got == want
