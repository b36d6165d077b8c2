from decimal import ROUND_HALF_UP, Decimal


from faultline.functions.numeric import exact_percent, round_ratio, share_exceeds


def _ref(c, t, k, scale=100):
    q = Decimal(c * scale) / Decimal(t)
    return float(q.quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP))


def test_exact_percent_matches_decimal_half_up(spark):
    pairs = [(c, t) for t in (1, 2, 3, 7, 8, 40, 200, 1000, 1041) for c in range(0, t + 1, max(1, t // 37))]
    df = spark.createDataFrame(pairs, "c long, t long")
    got = df.select("c", "t", exact_percent("c", "t", 1).alias("p1"), exact_percent("c", "t", 2).alias("p2"),
                    round_ratio("c", "t", 2).alias("r2")).collect()
    for r in got:
        assert r.p1 == _ref(r.c, r.t, 1), r
        assert r.p2 == _ref(r.c, r.t, 2), r
        assert r.r2 == _ref(r.c, r.t, 2, scale=1), r


def test_rounding_halves_go_up(spark):
    # 1/8 = 12.5 %, 1/16 = 6.25 %, 1/40 = 2.5 %: halves at 0, 1 and 0 decimals.
    df = spark.createDataFrame([(1, 8), (1, 16), (1, 40), (469, 16)], "c long, t long")
    got = [tuple(r) for r in df.select(exact_percent("c", "t", 0), exact_percent("c", "t", 1),
                                       round_ratio("c", "t", 2)).collect()]
    assert got[0] == (13.0, 12.5, 0.13)
    assert got[1] == (6.0, 6.3, 0.06)
    assert got[2] == (3.0, 2.5, 0.03)
    assert got[3][2] == 29.31


def test_share_threshold_is_strict_and_unrounded(spark):
    df = spark.createDataFrame([(2, 5), (40, 100), (401, 1000), (1, 3)], "c long, t long")
    got = [r[0] for r in df.select(share_exceeds("c", "t", 40)).collect()]
    assert got == [False, False, True, False]
    frac = [r[0] for r in df.select(share_exceeds("c", "t", 33.3)).collect()]
    assert frac == [True, True, True, True]


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(0, 0), (3, 0)], "c long, t long")
    assert [tuple(r) for r in df.select(exact_percent("c", "t"), round_ratio("c", "t")).collect()] == [
        (None, None), (None, None)]


def test_threshold_with_many_decimals(spark):
    df = spark.createDataFrame([(1, 3), (10**12, 3 * 10**12 + 1)], "c long, t long")
    got = [r[0] for r in df.select(share_exceeds("c", "t", 33.333333333)).collect()]
    assert got == [True, True]
    got = [r[0] for r in df.select(share_exceeds("c", "t", 33.3333333333333)).collect()]
    assert got == [True, False]


def test_rounding_with_huge_counts(spark):
    df = spark.createDataFrame([(10**15 + 1, 3 * 10**15)], "c long, t long")
    assert df.select(exact_percent("c", "t", 4)).first()[0] == 33.3333
    assert df.select(round_ratio("t", "c", 6)).first()[0] == 3.0  # 2.999999999999997
    big = spark.createDataFrame([(7 * 10**14, 10**15)], "c long, t long")
    assert big.select(round_ratio("t", "c", 6)).first()[0] == 1.428571
