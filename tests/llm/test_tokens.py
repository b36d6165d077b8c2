"""Token counts, the codec and token files against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from faultline.llm import queries as Q
from faultline.llm.bpe_codec import Codec, codec, decode, encode
from faultline.llm.arrays import SpanHasher
from faultline.llm.token_counts import count_tokens
from faultline.llm.token_files import ids_crc32, read_token_files, write_token_files
from faultline.llm.vocabulary import TextEncoder, char_classes, spans_of, text_encoder, vocabulary
from faultline.session import scratch_path
from tests.llm.helpers import awkward_texts, by_id, docs

PATH = Q.BYTE_BPE
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'", "'s", "'re", "'LL", "it's", "!", "é", "ß", "中", "٣", "½", " ", " ",
          "　", "\x1c", "\x85", "<|endoftext|>", "<|endof", "1", "23", "😀", "é", "​", " x", "\r\n", "aaaa", "tion"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(seed, n):
    rng = random.Random(seed)
    mixed = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    return mixed + ["".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(0, 90))) for _ in range(n)]


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_classes_of_characters(library):
    """Every character, between a letter and a digit and after a space."""
    kinds = char_classes()
    split = library.pre_tokenizer.pre_tokenize_str
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and c not in (32, 39)]
    for lo in range(0, len(points), 50_000):
        part = points[lo:lo + 50_000]
        begins = set()
        for _, (at, _) in split("".join(f"\na{chr(c)}1\na {chr(c)}a" for c in part)):
            begins.add(at)
        for i, c in enumerate(part):
            at = 9 * i + 1
            if at + 1 not in begins:
                kind = 0
            elif at + 2 not in begins:
                kind = 1
            else:  # other symbols join the space before them, white space does not
                kind = 2 if at + 5 in begins and at + 6 not in begins else 3
            assert kinds[c] == kind, hex(c)


@pytest.mark.parametrize("encoder", [codec, text_encoder])
def test_encoders_match_the_library(library, encoder):
    texts = random_texts(1, 1500) + [t or "" for t in awkward_texts()]
    got = encoder(PATH).encode(pa.array(texts)).to_pylist()
    for text, ids in zip(texts, got):
        assert ids == expected(library, text), text


def test_only_failing_words_are_merged(library):
    c = Codec(vocabulary(PATH))
    words = [w.encode() for w in (" hello", " unbelievable", " thonatat", "lo", " erwhingly")]
    data, starts, ends = spans_of(words)
    counts, flat = c.encode_words(SpanHasher(data), starts, ends)
    at = [0, *counts.cumsum().tolist()]
    assert [flat[i:j].tolist() for i, j in zip(at, at[1:])] == [expected(library, w.decode()) for w in words]
    assert 0 < c.merged_words < len(words)


def test_whole_tokens_are_proved_by_merging(library):
    vocab = vocabulary(PATH)
    rng = random.Random(4)
    for i in rng.sample(vocab.whole_ids.tolist(), 400):
        raw = vocab.token_bytes[i]
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        starts, _, counts, _ = vocab.pretokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if counts[0] == 1:
            assert expected(library, text) == [i]


def regular_words():
    """Words of two letters and their complements, whose polynomial hashes
    modulo 2**64 agree from 1,024 letters on, and long words of many letters."""
    out = []
    for size in (512, 1024, 2048, 4096, 65536):
        bits = [bin(i).count("1") % 2 for i in range(size)]
        out += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    rng = random.Random(8)
    return out + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(n)) for n in (129, 401, 5000)]


@pytest.mark.parametrize("encoder", [Codec, TextEncoder])
def test_long_regular_words_are_told_apart(library, encoder):
    words = regular_words()
    got = encoder(vocabulary(PATH)).encode(pa.array(words + [" ".join(words)])).to_pylist()
    for text, ids in zip(words + [" ".join(words)], got):
        assert ids == expected(library, text)


def test_long_regular_words_are_counted_and_written(spark, library):
    words = regular_words()
    df = docs(spark, words)
    counts, files = by_id(count_tokens(df, PATH)), scratch_path(spark, "token-files-regular")
    write_token_files(df, files, PATH, end_id=2)
    ids, digests = by_id(read_token_files(spark, files)), by_id(Q.codec_digests(df))
    for i, w in enumerate(words):
        want = expected(library, w)
        assert counts[i].n_tokens == len(want) and ids[i].ids == want + [2]
        assert digests[i].decoded_sha256 == hashlib.sha256(w.encode()).hexdigest()


@pytest.mark.parametrize("limit", [1, 50])
def test_a_forgetful_cache_changes_nothing(library, limit):
    encoder = TextEncoder(vocabulary(PATH))
    encoder.cache.limit = limit
    texts = random_texts(5, 300)
    for part in range(0, 300, 20):
        got = encoder.encode(pa.array(texts[part:part + 20])).to_pylist()
        assert got == [expected(library, t) for t in texts[part:part + 20]]
    assert encoder.cache.table.size < 5000


def test_counts_of_awkward_texts(spark, library):
    texts = awkward_texts()
    got = by_id(count_tokens(docs(spark, texts), PATH, limit=100))
    for i, t in enumerate(texts):
        n = len(expected(library, t))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
        assert got[i].lang == "en"


def test_counts_of_empty_table_and_clashing_columns(spark):
    none = count_tokens(docs(spark, []), PATH)
    assert none.count() == 0 and none.columns[-3:] == ["n_tokens", "n_bytes", "over_limit"]
    clash = docs(spark, ["a b"]).selectExpr("doc_id", "text", "'x' AS n_tokens", "'y' AS N_BYTES")
    row = count_tokens(clash, PATH).collect()[0]
    assert row.n_tokens == 2


def test_codec_round_trip(spark, library):
    texts = awkward_texts()
    got = by_id(decode(encode(docs(spark, texts, ids=[1007] * 2 + list(range(2, len(texts)))), PATH), PATH).where("doc_id <> 1007"))
    for i, t in list(enumerate(texts))[2:]:
        assert got[i].ids == expected(library, t)
        assert got[i].decoded == library.decode(got[i].ids, skip_special_tokens=False) == t
    assert decode(encode(docs(spark, []), PATH), PATH).count() == 0


def test_decoding_of_ids_that_are_no_text(spark, library):
    lists = [[], [50256, 50256], [0, 220], [vocabulary(PATH).byte_id[0xC3].item()], [vocabulary(PATH).byte_id[0xE4].item(), 64]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id long, ids array<int>")
    got = by_id(decode(df, PATH))
    for i, ids in enumerate(lists):
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)


def test_query_digests(spark, library):
    texts = awkward_texts()
    got = by_id(Q.codec_digests(docs(spark, texts)))
    for i, t in enumerate(texts):
        ids = expected(library, t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


@pytest.mark.parametrize("dictionary", [True, False])
def test_token_files(spark, library, dictionary):
    texts = awkward_texts()
    path = scratch_path(spark, "token-files-test")
    ids = list(reversed(range(0, 3 * len(texts), 3)))
    write_token_files(docs(spark, texts, ids=ids), path, PATH, end_id=2, dictionary=dictionary)
    got = by_id(ids_crc32(read_token_files(spark, path)))
    start = 0
    for i, t in sorted(zip(ids, texts)):
        want = expected(library, t) + [2]
        assert got[i].ids == want and got[i].n_tokens == len(want) and got[i].start == start
        assert got[i].ids_crc32 == zlib.crc32(struct.pack(f"<{len(want)}I", *want))
        start += len(want)
    one = read_token_files(spark, path, where="doc_id = 9").collect()
    assert len(one) == 1 and one[0].start == got[9].start


def test_token_files_keep_page_indexes_and_the_chosen_encoding(spark):
    for dictionary, encodings in ((True, {"RLE_DICTIONARY", "PLAIN_DICTIONARY"}), (False, {"DELTA_BINARY_PACKED"})):
        path = scratch_path(spark, "token-files-layout")
        write_token_files(docs(spark, awkward_texts()), path, PATH, end_id=2, dictionary=dictionary)
        files = spark.read.parquet(path).inputFiles()
        meta = pq.ParquetFile(files[0].removeprefix("file:")).metadata
        column = next(meta.row_group(0).column(k) for k in range(meta.num_columns)
                      if meta.row_group(0).column(k).path_in_schema.startswith("ids"))
        assert encodings & set(column.encodings)
        assert column.has_offset_index and column.has_column_index


def test_token_files_of_null_ids_repeats_and_no_rows(spark):
    path = scratch_path(spark, "token-files-odd")
    write_token_files(docs(spark, ["b", "a", "c", None], ids=[5, 5, None, 1]), path, PATH, end_id=2)
    rows = sorted((r.start, r.doc_id, r.ids) for r in read_token_files(spark, path).collect())
    assert [(d, i) for _, d, i in rows] == [(None, [66, 2]), (1, [2]), (5, [64, 2]), (5, [65, 2])]
    path = scratch_path(spark, "token-files-none")
    write_token_files(docs(spark, []), path, PATH, end_id=2)
    assert read_token_files(spark, path).count() == 0
