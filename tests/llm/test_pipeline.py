"""The pipeline's stages on a small corpus, each against its brute force."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from faultline.llm import frames
from faultline.llm import queries as Q
from tests.llm.helpers import docs, prose, shuffle_files
from tests.llm.test_classifiers import insults
from tests.llm.test_mixing import brute_force as mix
from tests.llm.test_near_dedup import brute_force as groups
from tests.llm.test_repeats import brute_force as repeats


def corpus(spark, path):
    toxic = insults(3, 120)
    shared = prose(1, 30)
    texts = [t for t, _ in toxic] + [f"{prose(50 + i, 30)} {shared} {prose(90 + i, 30)}" for i in range(8)]
    texts += [prose(400, 100), prose(400, 100), prose(400, 100) + " more", None, ""]
    sources = [("web", "book", "code", None)[i % 4] for i in range(len(texts))]
    docs(spark, texts, sources=sources).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(toxic)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return texts, toxic


def rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.orderBy("doc_id").collect()]


def test_stages(spark, tmp_path):
    texts, toxic = corpus(spark, str(tmp_path))
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "repeats", "mixing", "bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = frame.columns, None
    for k, (name, stage) in enumerate(C.STAGES):
        before = rows(frame)
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "bpe":
            assert frame.columns == columns
            after = rows(frame)
        if name == "toxicity":
            gone = {d for d, _, _ in before} - {d for d, _, _ in after}
            bad = {i for i, (_, y) in enumerate(toxic) if y}
            assert len(gone & bad) >= 0.9 * len(bad) and len(gone - bad) <= 4
        elif name == "near_dedup":
            keep = {d for d, _, c in groups([(d, t) for d, t, _ in before], 5, 80) if c == d}
            assert [d for d, _, _ in after] == sorted(keep) and {d for d, _, _ in before} - keep >= {129, 130}
        elif name == "repeats":
            want = {d: raw.decode("utf-8", "ignore") for d, _, _, _, raw in repeats([(d, t) for d, t, _ in before], 50)}
            assert {d: t for d, t, _ in after} == want and sum(map(len, want.values())) < sum(len(t or "") for _, t, _ in before)
            assert all(r.n_chars == len(r.text) for r in frame.collect())
        elif name == "mixing":
            times = {d: n // z for d, z, _, _, n in mix(before) if n}
            assert {d: sum(a[0] == d for a in after) for d in {a[0] for a in after}} == times
            kept = after
        else:
            got = sorted((r.doc_id, r.ids) for r in frame.collect())
            assert got == sorted((d, library.encode(t or "", add_special_tokens=False).ids) for d, t, _ in kept)
    run = E.queries()["pipeline"](spark, str(tmp_path))
    assert sorted((r.doc_id, r.ids) for r in run.collect()) == got


def test_stages_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    """The last query of a stage deletes its shuffle files too, not only the steps before it."""
    corpus(spark, str(tmp_path))
    monkeypatch.setattr(frames, "release_driver", lambda spark: None)
    left = {}

    def cut(spark, frame, sf_dir):
        out = C.remove_repeats(spark, frame, sf_dir)
        left["before"] = shuffle_files(spark)
        return out

    def look(spark, frame, sf_dir):
        left["after"] = shuffle_files(spark) - left["before"]
        return frame
    monkeypatch.setattr(C, "STAGES", [("repeats", cut), ("look", look)])
    assert C.run(spark, str(tmp_path)).count() == 133 and left["after"] == set()


def test_empty_documents(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    keys = set(E.queries())
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in keys) == 1
    assert "pipeline" in keys and set(Q.ORACLE_SQL) <= set(E.oracle_sql()) <= keys


def test_toxicity_stage_decides_as_op10(spark, tmp_path, monkeypatch):
    corpus(spark, str(tmp_path))
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    middle = Q.toxicity.Model(np.zeros(1 << Q.toxicity.BUCKET_BITS), -0.4)  # scores 0.4
    monkeypatch.setattr(Q, "toxicity_model", lambda *a: middle)
    monkeypatch.setattr(C, "toxicity_model", lambda *a: middle)
    called = {r.doc_id for r in Q.op10_toxicity(spark, str(tmp_path)).collect() if r.predicted}
    kept = {r.doc_id for r in C.reject_toxic(spark, frame, str(tmp_path)).collect()}
    assert called and not called & kept


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    """NULL ids and texts, repeated rows, blank and long texts, and columns named like the stages' own."""
    odd = [(None, None), (None, "a b c d e f"), (None, "a b c d e f"), (1, ""), (1, ""), (2, " \n "), (3, prose(9, 6000)),
           (4, prose(10, 80)), (5, prose(10, 80)), (5, prose(10, 80))]
    frame = docs(spark, [t for _, t in odd], ids=[i for i, _ in odd], sources=["s", None] * 5).selectExpr(
        "*", "'x' AS _toxic", "1 AS score", "2 AS size", "'k' AS key", "3 AS kept", "'t' AS tie", "4 AS label", "5 AS _copy")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    counts = {}
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        at = spark.read.parquet(f"{tmp_path}/{k}")
        counts[name] = at.count()
        assert name == "bpe" or at.columns == frame.columns
    # no label: everything stays or goes at 0.5; without labels the score is 0.5 and every text is rejected
    assert counts["toxicity"] == 0 and counts["bpe"] == 0
    deduped = C.near_dedup(spark, frame, str(tmp_path)).collect()
    texts = sorted(((r.doc_id, (r.text or "")[:11]) for r in deduped), key=str)
    # the copies of 4 go, rows of no shingle stay, NULL ids alone keep no name and stay
    assert [d for d, _ in texts if d is not None] == [1, 1, 2, 3, 4]
    mixed = C.mix(spark, frame, str(tmp_path))
    assert mixed.columns == frame.columns and mixed.where("text IS NULL OR trim(text) = ''").count() == 0
    tokens = C.tokenize(spark, frame, str(tmp_path))
    assert tokens.count() == len(odd) and tokens.where("n_tokens = 0").count() == 3
