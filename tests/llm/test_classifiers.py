"""Quality and toxicity models: held-out accuracy, gradients, awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import quality, toxicity
from faultline.llm import queries as Q
from faultline.llm.labelled import bounded_sample, id_remainder, training_sample
from tests.llm.helpers import awkward_texts, docs, prose


def insults(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words, bad = prose(rng.randrange(10 ** 6), rng.randint(20, 120)).split(), i % 4 == 0
        if bad:
            for _ in range(max(2, len(words) // 15)):
                w = rng.choice(["blorpish", "snarkode", "grumbluk"])
                words.insert(rng.randrange(len(words)), w + rng.choice(["", "s", "ing", "zz"]))
        out.append((" ".join(words), int(bad)))
    return out


def junk(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text, good = prose(rng.randrange(10 ** 6), rng.randint(30, 300)), i % 3 > 0
        if not good:
            w = text.split()
            kind = rng.randrange(3)
            tail = (" | ".join(w) if kind == 0 else " ".join(x.upper() + "!!" for x in w) if kind == 1
                    else " ".join(w[:2] * (len(w) // 2)))
            text = " ".join(w[:20]) + "\n" + tail
        out.append((text, int(good)))
    return out


@pytest.mark.parametrize("module, made", [(toxicity, insults), (quality, junk)])
def test_held_out_accuracy(module, made):
    model = module.train(made(1, 600))
    held = made(2, 300)
    score = model.scores(pa.array([t for t, _ in held]))
    right = ((score >= 0.3) == np.array([y for _, y in held])).mean()
    assert right >= 0.93
    assert ((0 <= score) & (score <= 1)).all()


def test_misspelt_words_share_subwords():
    model = toxicity.train(insults(1, 600))
    plain = prose(12345, 60)
    low, high = model.scores(pa.array([plain, plain + " " + " ".join(["blorpisch", "xsnarkode", "grumblook"] * 3)]))
    assert high > 0.5 > low


def test_attention_weighs_the_passages_of_a_document():
    rng = np.random.default_rng(0)
    model = quality.Model({k: v.astype(np.float64) for k, v in quality._blank(rng).items()})
    x, count = rng.random((9, quality.FEATURES)), np.array([2, 4, 3])
    h, t, g, a, z, logit = model.forward(x, count)
    assert np.allclose(np.add.reduceat(a, [0, 2, 6]), 1) and logit.shape == (3,)
    for i, (lo, hi) in enumerate(((0, 2), (2, 6), (6, 9))):
        assert np.allclose(z[i], (a[lo:hi, None] * h[lo:hi]).sum(axis=0))


def test_the_first_step_goes_against_the_numeric_gradient(monkeypatch):
    """Adam's first step has the size of the rate and the sign of the gradient:
    compared with differences of the loss, for every kind of weight."""
    monkeypatch.setattr(quality, "EPOCHS", 1)
    sample = junk(4, 40)  # one batch
    after = quality.train(sample).w
    before = {k: v.astype(np.float64) for k, v in quality._blank(np.random.default_rng(3)).items()}
    before["mean"], before["scale"] = after["mean"].astype(np.float64), after["scale"].astype(np.float64)
    text = pa.array([t for t, _ in sample])
    data, offsets = quality.utf8_column(text)
    x, count = quality.passages(data, offsets)
    y = np.array([label for _, label in sample], np.float64)

    def loss(w):
        logit = quality.Model(w).forward(x.astype(np.float64), count)[-1]
        return np.mean(np.logaddexp(0, logit) - y * logit)

    rng, checked = np.random.default_rng(1), 0
    for k in ("enc", "enc_b", "att", "gate", "att_w", "out", "out_b"):
        flat = before[k].reshape(-1)
        for i in rng.permutation(flat.size)[:40].tolist():
            sides = []
            for d in (1e-5, -1e-5):
                moved = flat.copy()
                moved[i] += d
                sides.append(loss(before | {k: moved.reshape(before[k].shape)}))
            grad = (sides[0] - sides[1]) / 2e-5 + 1e-4 * flat[i]
            if abs(grad) > 1e-5:
                step = flat[i] - after[k].reshape(-1)[i]
                assert np.sign(step) == np.sign(grad) and abs(abs(step) - 0.0101) < 2e-4, (k, i, grad, step)
                checked += 1
    assert checked > 100


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_are_the_same_alone_and_together(module):
    model = module.train((insults if module is toxicity else junk)(3, 200))
    texts = [t for t in awkward_texts()] + [prose(5, 20000)]
    together = model.scores(pa.array(texts, pa.string()))
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6) and np.isfinite(together).all()


@pytest.mark.parametrize("module", [toxicity, quality])
def test_without_both_labels_the_score_is_constant(module):
    for sample in ([], [("a b", 1)] * 5, [("a b", 0)] * 5):
        s = module.train(sample).scores(pa.array(["x y", None, ""]))
        assert len(set(s.tolist())) == 1 and 0 < s[0] < 1


def test_passages_cover_whole_texts():
    texts = ["", "  ", "one", prose(1, quality.PASSAGE_WORDS), prose(2, quality.PASSAGE_WORDS + 1), prose(3, 1000)]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t) for t in texts])
    _, count = quality.passages(np.frombuffer(data, np.uint8), offsets)
    assert count.tolist() == [1, 1, 1, 1, 2, -(-1000 // quality.PASSAGE_WORDS)]


def labelled_tables(spark, path, made, label):
    rows = made(7, 160)
    docs(spark, [t for t, _ in rows] + awkward_texts()).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, y, y) for i, (_, y) in enumerate(rows)] + [(3, None, None), (None, 1, 1), (99999, 1, 1)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


@pytest.mark.parametrize("key, made, modulus, held", [("op2_quality", junk, 5, 0), ("op10_toxicity", insults, 4, 2)])
def test_queries(spark, tmp_path, key, made, modulus, held):
    import zlib
    rows = labelled_tables(spark, str(tmp_path), made, key)
    got = {r.doc_id: r for r in Q.QUERIES[key](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows) + len(awkward_texts())
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % modulus == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert sum(got[i].predicted == y for i, (_, y) in enumerate(rows)) >= 0.85 * len(rows)


def test_sample_is_bounded_and_ignores_held_out_rows(spark):
    df = docs(spark, [f"text {i}" for i in range(40)] + ["x" * 100, None, "twice"], ids=[*range(40), 40, 41, 5])
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)] + [(1, 0), (7, None)], "doc_id long, y int")
    learn = id_remainder("doc_id", 4) != 2
    sample = training_sample(df, labels, "y", learn, (6, 30), 50)
    assert sum(y == 0 for _, y in sample) == 6 and sum(y == 1 for _, y in sample) <= 20
    allowed = {f"text {r.doc_id}" for r in df.where(learn).collect()} | {"twice"}
    assert {t for t, _ in sample} <= allowed
    assert sample == training_sample(df.repartition(3), labels, "y", learn, (6, 30), 50)
    none = training_sample(docs(spark, []), labels, "y", F.lit(True), (5, 5), 50)
    assert none == []


def test_empty_tables_and_replaced_columns(spark):
    model = toxicity.train([])
    assert toxicity.score(docs(spark, []), model).count() == 0
    again = toxicity.score(docs(spark, ["a"]).withColumn("score", F.lit("old")), model)
    assert again.columns.count("score") == 1 and again.collect()[0].score == 0.5


def test_toxicity_learns_from_long_documents(spark):
    long = [(prose(i, 2500) + (" blorpish snarkode" * 150 if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(40)]
    df = docs(spark, [t for t, _ in long])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(long)], "doc_id long, toxic int")
    assert min(len(t) for t, _ in long) > 8192
    model = Q.toxicity_model(df, labels)
    low, high = model.scores(pa.array([prose(77, 3000), prose(77, 3000) + " blorpish snarkode" * 180]))
    assert high > 0.5 > low


def test_sample_is_bounded_by_total_bytes_and_holds_every_length(spark):
    df = docs(spark, ["x" * (10 + 30 * (i % 4)) for i in range(80)] + [None], ids=[*range(80), 80])
    labels = spark.createDataFrame([(i, i % 2) for i in range(81)], "doc_id long, y int")
    learn = id_remainder("doc_id", 4) != 2
    got = bounded_sample(df, labels, "y", learn, (100, 8), (700, 10 ** 6), 60).collect()
    clean = [min(60, len(r.text)) for r in got if r.label == 0]
    assert 640 < sum(clean) <= 700 and {len(r.text) for r in got} == {10, 40, 70, 100}
    assert sum(r.label == 1 for r in got) == 8
    assert {r.doc_id for r in got} <= {r.doc_id for r in df.where(learn).collect()}
