"""I-Match document fingerprints over randomised lexicons (operator 7).

The lexicon holds the terms whose inverse document frequency lies in a chosen
band.  Its subsets are random and nested: level by level half of the terms are
left, and each level is dealt over SUBSETS subsets.  A document uses the level
that leaves it at most MOST_TERMS terms, so a subset holds one or two of them
whatever the document's length, and half a text that stays leaves many subsets
untouched.  Each subset gives one hash, of the document's distinct terms in it;
one more hash is of all lexicon terms, so an edit to any of them shows.  Two
fingerprints are compared on the sparser level of the two: they are as alike as
the share of equal hashes, among those that hold a term of either.  A text that
the band leaves too few terms of is compared by all its own terms likewise.

DataFrame operations only.  Document frequencies are counted over the whole
corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import written

BAND = (0.005, 0.2)    # share of the documents that hold a lexicon term
SUBSETS = 32           # a power of two
MOST_TERMS = 32        # of a document on its level
EVERY_TERM = (1 << 63) - 1  # limit of level 0
FEW_TERMS = 20         # a text with fewer lexicon terms is compared by all its terms,
FEW_SHARE = 0.25       # and one with a smaller share of its terms in the lexicon
ROWS_A_RANGE = 400     # documents of a range of ids that are ordered together
MOST_RANGES = 1 << 16


def terms(text: Column) -> Column:
    """Hashes (63 bits) of the distinct lower-cased runs of letters and digits."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(EVERY_TERM))))


def _level(held: Column) -> dict[str, Column]:
    """Parts of the level of an array of term hashes.

    A level holds the hashes below a power of two, its limit: the largest that
    leaves MOST_TERMS at most.  ``beyond`` is the first hash that is one too
    many (NULL if none is), ``first`` those before it, ``whole`` the exclusive
    or of all, which stands for the set in any order."""
    ascending = F.array_sort(held)
    whole = F.aggregate(held, F.lit(None).cast("long"), lambda a, h: F.coalesce(a, F.lit(0).cast("long")).bitwiseXOR(h))
    return {"whole": whole, "beyond": F.get(ascending, F.lit(MOST_TERMS)), "first": F.slice(ascending, 1, MOST_TERMS)}


def lexicon_terms(docs: DataFrame, band: tuple[float, float] = BAND, text_col: str = "text") -> DataFrame:
    """Every term in the band, once.

    The share's lower edge bounds the terms: their document counts add up to
    the corpus's distinct (document, term) pairs.
    """
    total = docs.count()
    counted = docs.select(F.explode(terms(F.coalesce(F.col(text_col), F.lit("")))).alias("term")).groupBy("term").count()
    inside = counted.where((F.col("count") >= max(2, band[0] * total)) & (F.col("count") <= max(2, band[1] * total)))
    return inside.select("term")


def _ranges(docs: DataFrame) -> Column:
    """The range of ids each document falls into; ranges ascend with the ids.

    Bounds are quantiles of an id sample; they only balance the ranges.
    """
    total = docs.count()
    count = min(MOST_RANGES, max(1, total // ROWS_A_RANGE))
    every = max(1, total // (16 * count))
    if count == 1:
        return F.lit(0)
    sample = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0))
    shares = ",".join(f"{i / count:.9g}" for i in range(1, count))
    got = sample.agg(F.expr(f"percentile_approx(doc_id, cast(split('{shares}', ',') as array<double>), 100000)")
                     .alias("b")).first()["b"]
    bounds = sorted(set(got or []))
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))

    def literal(values):  # folds into one constant
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda b: b <= F.col("doc_id")))
    coarse = below(literal(bounds[::step]))
    fine = below(F.slice(literal(bounds), (coarse - 1) * step + 1, F.lit(step)))
    return (F.when(F.col("doc_id").isNull(), -1).when(coarse == 0, 0)
            .otherwise((coarse - 1) * step + fine)).cast("int")


def _next_head(heads: DataFrame, value: str) -> DataFrame:
    """For every range, ``value`` of the first row of the next one (after the
    last: of the first).  One row a range, at most MOST_RANGES + 2."""
    by = Window.orderBy("range")
    first = F.first(value).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return heads.select("range", F.coalesce(F.lead(value).over(by), first).alias("head"))


def subset_hashes(mark: Column, limit: Column) -> Column:
    """The hash of all terms, and of each subset the exclusive or of the picks
    below ``limit`` that are in it, by their last bits; NULL where none is."""
    def of(k):
        return F.aggregate(mark["picks"], F.lit(None).cast("long"), lambda a, h: F.when(
            (h < limit) & (h.bitwiseAND(F.lit(SUBSETS - 1)) == k), F.coalesce(a, F.lit(0).cast("long")).bitwiseXOR(h)).otherwise(a))
    return F.concat(F.array(mark["whole"]), F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), of))


def with_likeness(rows: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with a likeness for each name in ``pairs``, of two mark columns:
    the share of equal hashes among those that hold a term of either, on the
    sparser level of the two; by all terms if the lexicon has too few of a
    text's.  Texts without any term are alike."""
    sides = rows
    for name, (a, b) in pairs.items():
        few = F.col(a)["few"] | F.col(b)["few"]
        sides = sides.withColumns({f"_a_{name}": F.when(few, F.col(a)["own"]).otherwise(F.col(a)["known"]),
                                   f"_b_{name}": F.when(few, F.col(b)["own"]).otherwise(F.col(b)["known"])})
    both = {name: F.arrays_zip(subset_hashes(F.col(f"_a_{name}"), limit).alias("a"), subset_hashes(F.col(f"_b_{name}"), limit).alias("b"))
            for name in pairs
            for limit in [F.least(F.col(f"_a_{name}")["limit"], F.col(f"_b_{name}")["limit"])]}
    zipped = sides.withColumns({f"_z_{name}": z for name, z in both.items()})

    def share(z: Column) -> Column:
        some = F.size(F.filter(z, lambda p: p["a"].isNotNull() | p["b"].isNotNull()))
        same = F.size(F.filter(z, lambda p: p["a"] == p["b"]))
        return F.when(some > 0, same / some).otherwise(F.lit(1.0))

    return zipped.select(*rows.columns, *[share(F.col(f"_z_{name}")).alias(name) for name in pairs])


def text_of(mark: Column) -> Column:
    """A fingerprint as a string: the bits of its level's limit, then 8 hex
    digits a hash, none for an empty one; "all:" before it if it is of all terms."""
    def digits(side: Column) -> Column:
        hashes = F.transform(subset_hashes(side, side["limit"]), lambda h: F.coalesce(
            F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0"), F.lit("")))
        return F.concat_ws("-", F.length(F.bin(side["limit"])).cast("string"), F.array_join(hashes, "-"))
    return F.when(mark["few"], F.concat(F.lit("all:"), digits(mark["own"]))).otherwise(digits(mark["known"]))


def fingerprints(docs: DataFrame, keys: list[str], texts: list[str], lexicon_rows: DataFrame,
                 carried: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` reduced to ``keys`` and ``carried`` plus, for every text column
    t, t_mark: ``known`` and ``own``, the level (whole, limit, picks) of the
    lexicon's terms and of all terms, and ``few``, whether the lexicon has too
    few of the text's terms.

    ``keys`` identify the rows; the ``carried`` columns travel with one entry a
    row.  Grouping keeps the rows' partitioning when it is by some of the keys.
    ``lexicon_rows`` have a column term.
    """
    def entry(i: int, term: Column, first: bool) -> Column:
        own = [F.col(c) if first else F.lit(None).cast(docs.schema[c].dataType) for c in carried]
        return F.struct(F.lit(i).alias("which"), term.alias("term"), *[c.alias(n) for c, n in zip(own, carried)])

    def marked(i: int) -> Column:  # the NULL term keeps texts without any
        one = F.array(entry(i, F.lit(None).cast("long"), True))
        return F.concat(one, F.transform(terms(F.coalesce(F.col(texts[i]), F.lit(""))), lambda x: entry(i, x, False)))

    entries = F.concat(*[marked(i) for i in range(len(texts))])
    known = lexicon_rows.select("term").distinct().withColumn("listed", F.lit(True))
    each = (docs.select(*keys, F.explode(entries).alias("e")).select(*keys, "e.*").join(F.broadcast(known), "term", "left"))

    def of(i: int, column: Column) -> Column:
        return F.collect_list(F.when(F.col("which") == i, column))  # NULLs are not collected

    lists = [of(i, column).alias(f"{part}{i}") for i in range(len(texts))
             for part, column in (("all", F.col("term")), ("known", F.when(F.col("listed"), F.col("term"))))]
    grouped = each.groupBy(*keys).agg(*[F.max(c).alias(c) for c in carried], *lists)
    sides = {f"{part}{i}": _level(F.col(f"{part}{i}")) for i in range(len(texts)) for part in ("all", "known")}
    out = grouped.withColumns({f"{n}_{x}": v for n, parts in sides.items() for x, v in parts.items()})
    out = out.withColumns({f"{n}_limit": F.coalesce(F.expr(f"shiftleft(1L, length(bin({n}_beyond)) - 1)"), F.lit(EVERY_TERM)) for n in sides})

    def side(n: str) -> Column:
        limit = F.col(f"{n}_limit")
        return F.struct(F.col(f"{n}_whole").alias("whole"), limit.alias("limit"),
                        F.filter(F.col(f"{n}_first"), lambda h: h < limit).alias("picks"))

    marks = []
    for i, t in enumerate(texts):
        n, n_known = F.size(f"all{i}"), F.size(f"known{i}")
        few = (n_known < FEW_TERMS) | (n_known < FEW_SHARE * n)
        marks.append(F.struct(side(f"known{i}").alias("known"), side(f"all{i}").alias("own"), few.alias("few")).alias(f"{t}_mark"))
    return out.select(*keys, *carried, *marks)


def edited_fingerprints(docs: DataFrame, band: tuple[float, float] = BAND, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the code points (rounded down)
    replaced by the first as many of the next document in ascending id order;
    the last document's next is the first.  NULL text counts as empty; NULL ids
    come first; rows of one id are ordered by text.  Equal texts have equal
    fingerprints; a pair is compared by all terms if the lexicon has too few of
    either text's (two empty texts are alike, 1.0).  A single document is its own next.  An
    empty table gives an empty one; other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = written(lexicon_terms(source, band), "imatch-lexicon")
    ranged = source.withColumn("range", _ranges(source))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    some_null = F.count_if(F.col("doc_id").isNull()) > 0
    lowest = ranged.groupBy("range").agg(F.when(~some_null, F.min("doc_id")).alias("doc_id"))
    first = (ranged.join(F.broadcast(lowest.withColumnRenamed("doc_id", "low")), "range")  # a row a range
             .where(F.col("doc_id").eqNullSafe(F.col("low"))).groupBy("range").agg(F.min("text").alias("text")))
    heads = written(_next_head(first, "text"), "imatch-heads")
    by_id = Window.partitionBy("range").orderBy(*order)
    beside = (ranged.withColumn("row", F.row_number().over(by_id)).withColumn("after", F.lead("text").over(by_id))
              .join(heads.hint("merge"), "range", "left"))
    n_chars = F.length("text").cast("long")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"),
                      F.expr("substring(following, 1, cast(floor(n_chars / 2) as int))"))
    pairs = (beside.withColumn("n_chars", n_chars).withColumn("following", F.coalesce("after", "head"))
             .select("range", "row", "doc_id", "n_chars", "text", edited.alias("edited"))
             .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    marked = written(fingerprints(pairs, ["range", "row"], ["text", "edited"], words, ("doc_id", "n_chars", "edited_sha256")),
                     "imatch-fingerprints")
    heads = _next_head(marked.where("row = 1").select("range", "text_mark"), "text_mark")
    by_row = Window.partitionBy("range").orderBy("row")
    beside = (marked.withColumn("after", F.lead("text_mark").over(by_row)).join(heads.hint("merge"), "range")
              .withColumn("after", F.coalesce("after", "head")))
    compared = with_likeness(beside, {"near_edited": ("text_mark", "edited_mark"), "near_next": ("text_mark", "after")})
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("text_mark")).alias("fingerprint"),
        text_of(F.col("edited_mark")).alias("edited_fingerprint"), "near_edited", "near_next")
