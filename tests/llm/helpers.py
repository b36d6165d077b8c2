"""Small tables with the awkward cases every operator must define."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WORDS = ("the of and to a in is that for it was on with as his be at by this had not are but from or have an "
         "they which one you were all her she there would their we him been has when who will no more if out so").split()


def docs(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["web"] * len(texts) if sources is None else sources
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t))
                                  for i, t, s in zip(ids, texts, sources)], DOCS)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "ing", "s", "ly"]) for _ in range(n))


def awkward_texts():
    """Null, empty, blank, short, repeated, shared passages, near copies, a long text, special strings."""
    shared = prose(1, 40)
    base = prose(2, 120)
    near = base.replace(base.split()[60], "changed", 1)
    return [None, "", "  \n\t ", "one", "two words", "Two WORDS", base, base, near, near.upper(),
            prose(3, 30) + " " + shared + " " + prose(4, 25), prose(5, 10) + "\n" + shared, shared,
            "ab" * 200, "é中😀 it's <|endoftext|> don't 'll 12٣½ 　x\r\n\r\n  end", prose(6, 3000),
            "aaaa" * 60, "<|endoftext|>", "x" * 50, "y" + "x" * 50, prose(7, 4), prose(7, 4) + "."]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def shuffle_files(spark):
    """Names of the shuffle files that the session holds on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}
