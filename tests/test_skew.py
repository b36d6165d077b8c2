"""One key holding a third of all rows: results stay whole and exact."""

from collections import Counter

import pytest

from faultline.operators import analysis as A
from faultline.operators import feedback as FB
from faultline.operators.joins import Dim
from tests.conftest import rows

N = 3000


@pytest.fixture(scope="module")
def skewed(spark):
    data = [(i, 0 if i % 3 == 0 else i % 50, "hot" if i % 3 == 0 else f"m{i % 7}") for i in range(N)]
    fact = spark.createDataFrame(data, "id long, g long, m string").repartition(6)
    dim = spark.createDataFrame([(g, f"G{g}") for g in range(50)], "g long, g_name string")
    return data, fact, dim


@pytest.mark.parametrize("bmax", [None, 0])
def test_frequency_and_dominance_under_skew(skewed, bmax):
    data, fact, dim = skewed
    kw = {} if bmax is None else {"broadcast_max_rows": bmax}
    dims = [Dim(dim, on="g", columns=["g_name"])]
    freq = dict(((r[0], r[1]), r[2]) for r in rows(A.frequency_by_keys(fact, ["g_name", "m"], dims, **kw)))
    want = Counter((f"G{g}", m) for _, g, m in data)
    assert freq == dict(want)
    dom = rows(A.dominant_member(fact, "g_name", "m", 40, dims, **kw))
    hot = [r for r in dom if r[0] == "G0"]
    assert hot == [("G0", "hot", N // 3, N // 3 + sum(1 for _, g, m in data if g == 0 and m != "hot"),
                    hot[0][4], "High persistence")]


def test_first_example_and_share_under_skew(skewed):
    data, fact, _ = skewed
    ex = dict(rows(FB.first_example_per_group(fact, "g", "id"), "g", "id"))
    assert ex[0] == 0 and len(ex) == 50
    shares = rows(A.share_within_group(fact, "g", "m"))
    assert sum(r[2] for r in shares) == N
