import math
import re
from collections import Counter


from faultline.operators import text as T
from tests.conftest import rows

TEXTS = ["The query  misses a quote.", "the  JOIN is\nwrong. don't", "  don't  repeat\tthe table  ", None,
         "Ünïcode wörds 🙂 the"]


def _df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")


def test_top_words_matches_counter(spark):
    want = Counter(w.lower() for t in TEXTS if t for w in t.split())
    got = rows(T.top_words(_df(spark), "t", n=5))
    expect = sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert got == expect


def test_word_weights_drop_stopwords(spark):
    got = dict((w, (n, x)) for w, n, x in rows(T.word_weights(_df(spark), "t", n=50)))
    assert "the" not in got and "don't" not in got
    assert got["query"] == (1, 1.0)


def test_histogram_counts_sum_and_edges(spark):
    vals = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = rows(T.histogram_equal_width(df, "x", bins=4))
    assert [r[0] for r in got] == [0, 1, 2, 3]
    assert [r[3] for r in got] == [3, 2, 3, 4]   # 0-2 | 3-4 | 5-7 | 8-10 (last bin closed)
    assert got[0][1] == 0.0 and got[3][2] == 10.0
    assert sum(r[3] for r in got) == len(vals)


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(7,)] * 5, "x int")
    got = rows(T.histogram_equal_width(df, "x", bins=3))
    assert [r[3] for r in got] == [5, 0, 0]


def test_density_curve_matches_numpy_style_kde(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 8.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = rows(T.density_curve(df, "x", points=11, count_bins=None, decimals=None))
    n = len(vals)
    mean = sum(vals) / n
    sd = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1))
    bw = sd * n ** -0.2
    lo, hi = min(vals), max(vals)
    for point, x, d in got:
        gx = lo + point * (hi - lo) / 10
        want = sum(math.exp(-0.5 * ((gx - v) / bw) ** 2) for v in vals) / (n * bw * math.sqrt(2 * math.pi))
        assert abs(x - gx) < 1e-12 and abs(d - want) < 1e-12
    assert got[-1][1] == hi


def test_density_of_equal_values_is_empty(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert T.density_curve(df, "x", points=5).count() == 0
    one = spark.createDataFrame([(1.0,)], "x double")
    assert T.density_curve(one, "x", points=5).count() == 0


def test_histogram_of_huge_integers(spark):
    base = 9 * 10**18
    df = spark.createDataFrame([(base,), (base + 10**17,), (base + 2 * 10**17,)], "x long")
    got = T.histogram_equal_width(df, "x", bins=40).collect()
    assert sum(r["count"] for r in got) == 3 and got[-1]["bin_hi"] == float(base + 2 * 10**17)


def test_cloud_words_drop_punctuation_possessives_and_plurals(spark):
    df = spark.createDataFrame([("The clauses, the clause. A clause! Class 42 query's queries a b2",), (None,)], "t string")
    got = {r.word: r.n for r in T.cloud_words(df, "t").collect()}
    assert got == {"clause": 3, "class": 1, "query": 1, "queries": 1, "b2": 1}


CLOUD = ["New York's taxis; a new york taxi, 12 New York taxis", "new york the new york", "Cats chase a cat's mouse. Cat chases mice",
         None, "", "42", "it's 1990's rock rock rock'n'roll", "glass glasses glas", "new york " * 20 + "old town"]


def _cloud_python(texts, threshold):
    """Words and pairs in plain Python: (words, pairs with scores, both in one list)."""
    stop, seq = T.STOPWORDS, []
    for t in texts:
        runs = [re.sub(r"'s$", "", w) for w in re.findall(r"\w[\w']+", (t or "").lower())]
        seq.append([w for w in runs if not w.isdecimal()])
    single = lambda w: w[:-1] if w.endswith("s") and not w.endswith("ss") and len(w) > 2 else w
    raw = Counter(w for ws in seq for w in ws if w not in stop)
    form = {w: single(w) if single(w) in raw else w for w in raw}
    words = Counter()
    for w, n in raw.items():
        words[form[w]] += n
    raw2 = Counter(p for ws in seq for p in zip(ws, ws[1:]) if not stop & set(p))
    pairs = Counter()
    for (a, b), n in raw2.items():
        pairs[a, single(b) if (a, single(b)) in raw2 else b] += n
    total = sum(words.values())

    def ll(k, n, p):
        return k * math.log(max(p, 1e-10)) + (n - k) * math.log(max(1 - p, 1e-10))

    kept = {}
    for (a, b), n in pairs.items():
        x, y = words[form[a]], words[form[b]]
        if total > x and total > y:
            score = 2 * (ll(n, x, n / x) + ll(y - n, total - x, (y - n) / (total - x)) - ll(n, x, y / total) - ll(y - n, total - x, y / total))
            if score > threshold:
                kept[a, b] = (n, score)
    left = Counter(words)
    for (a, b), (n, _) in kept.items():
        left[form[a]] -= n
        left[form[b]] -= n
    return words, kept, {w: n for w, n in left.items() if n > 0} | {f"{a} {b}": n for (a, b), (n, _) in kept.items()}


def test_words_and_collocations_match_plain_python(spark):
    df = spark.createDataFrame([(t,) for t in CLOUD], "t string").repartition(3)
    for threshold in (0.5, 5.0, 30.0):
        words, kept, both = _cloud_python(CLOUD, threshold)
        assert dict(rows(T.cloud_words(df, "t"))) == words
        got = {(r["first"], r["second"]): (r["n"], r["score"]) for r in T.collocations(df, "t", threshold=threshold).collect()}
        assert got.keys() == kept.keys() and all(got[k][0] == n and abs(got[k][1] - s) < 1e-9 for k, (n, s) in kept.items())
        assert dict(rows(T.cloud_words_and_pairs(df, "t", threshold=threshold))) == both
    assert ("new", "york") in kept and "new" not in both  # taken by the pair


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "t string")
    assert T.collocations(empty, "t").count() == 0 and T.word_weights(empty, "t", pairs=True).count() == 0
    one = spark.createDataFrame([("word",), ("word word",)], "t string")
    assert T.collocations(one, "t", threshold=0.0).count() == 0  # a word that is all there is


def test_pairs_are_counted_without_stop_words_and_shuffled_once(spark):
    texts = ["the red house and the red houses", "a red house", None]
    words, pairs = T._words_and_pairs(spark.createDataFrame([(t,) for t in texts], "t string"), "t", T.STOPWORDS)
    assert {(r["first"], r["second"], r["n"]) for r in pairs.collect()} == {("red", "house", 3)}
    assert {(r["word"], r["n"]) for r in words.collect()} == {("red", 3), ("house", 3)}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.index("Aggregate [") < plan.index("INSET") < plan.index("Generate")


def test_stop_words_are_looked_up_without_possessives(spark):
    df = spark.createDataFrame([("big cat's dog's bone",)], "t string")
    found = lambda stop: {r["pair"] for r in T.collocations(df, "t", stopwords=stop, threshold=-1.0).collect()}
    assert found(["cat", "dog's"]) == {"dog bone"} and found([]) == {"big cat", "cat dog", "dog bone"}


def test_word_counting_runs_one_regex_per_occurrence(spark):
    plan = T.cloud_words(_df(spark), "t")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    counted = next(i for i, line in enumerate(lines) if "Aggregate [_w" in line)  # below it: for every occurrence
    assert not any("regexp_replace" in line for line in lines[counted + 1:]) and plan.count("regexp_extract_all") <= 2


def test_binned_density_is_near_the_exact_curve_and_shuffles_the_grid(spark):
    df = spark.range(0, 100000, 1, 4).selectExpr("id", "sin(id * 0.7311) * 10 + (id % 97) / 7 AS x")
    some = df.filter("id < 3000")
    exact = rows(T.density_curve(some, "x", points=50, decimals=None))
    binned = rows(T.density_curve_binned(some, "x", points=50, decimals=None))
    top = max(d for *_, d in exact)
    assert [(p, x) for p, x, _ in binned] == [(p, x) for p, x, _ in exact]
    lo, hi = exact[0][1], exact[-1][1]
    n = 3000
    sd = some.selectExpr("stddev_samp(x)").first()[0]
    bound = ((hi - lo) / 4096 / (sd * n ** -0.2)) ** 2 / 8  # of a kernel's height, for each value
    height = n * (hi - lo) / 40 / (sd * n ** -0.2 * math.sqrt(2 * math.pi))
    assert max(abs(a - b) for (*_, a), (*_, b) in zip(exact, binned)) <= bound * height and bound * height < 0.01 * top
    many = T.density_curve_binned(df, "x", points=50, grid=256)
    assert many.count() == 50
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    fan_out = plan.index("Generate")  # of the kernels; below it the values are summed by edge
    assert "Aggregate" in plan[fan_out:plan.index("Generate", fan_out + 1)]


def test_binned_density_of_equal_values_and_none(spark):
    same = spark.createDataFrame([(2.0,)] * 4, "x double")
    assert T.density_curve_binned(same, "x").count() == 0
    assert T.density_curve_binned(same.limit(0), "x").count() == 0
    assert T.density_curve_binned(spark.createDataFrame([(None,), (1.0,)], "x double"), "x").count() == 0
