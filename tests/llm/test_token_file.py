import heapq
import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from policy_mart.llm import queries, token_file
from policy_mart.workdir import work_dir

from .frames import empty, messy, messy_rows, rows_of, words

JSON = token_file.json_of(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER = Tokenizer.from_str(JSON)
DATA = "/root/testdata/sf0.001"


def plain(text):
    return [*(TOKENIZER.encode(text, add_special_tokens=False).ids if text else []), 1]


def encoded(text, kind="<u2"):
    raw = token_file.token_ids(pa.array([None, text, "", text]), JSON, 1, True, kind).to_pylist()
    assert raw[0] == raw[2] == np.array([1], kind).tobytes() and raw[1] == raw[3]
    return np.frombuffer(raw[1], kind).tolist()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def written(spark, docs, **kwargs):
    path = work_dir(spark, "token-test")
    token_file.write_ids(docs, path, JSON, 1, by_word=True, **kwargs)
    return path


def by_hand(rows):
    """(doc_id, start, n, crc) of rows (doc_id, text) in ascending order."""
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(text)
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_query_against_plain_encoding(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_huffman"](spark, DATA)
    assert rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(by_hand(docs), key=repr)


def test_messy_documents_with_small_blocks_and_many_parts(spark):
    layout = token_file.Layout(limit=14, block=64, stride=8, part=500)
    rows = [(r[0], r[1]) for r in messy_rows()]
    rows = [(i if i is None else 7 * i, t) for i, t in rows] + [(50 + i % 2, words(i, 40)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = written(spark, docs, layout=layout)
    got = token_file.read_ids(spark, path, layout).orderBy("start").collect()
    # Keys ascend, nulls first, and every start is the number of ids before.
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == sorted(
        ((i, len(plain(t)), crc(plain(t))) for i, t in rows), key=key
    )
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.agg(F.max("n")).first()[0] <= 64 and blocks.select("part").distinct().count() > 5


def test_ids_come_back(spark):
    docs = messy(spark)
    pieces = token_file.read_tokens(spark, written(spark, docs)).orderBy("part", "first", "piece").collect()
    got = {}
    for p in pieces:
        got.setdefault((p["part"], p["first"], p["doc_id"]), []).extend(p["ids"])
    assert sorted(((k[2], v) for k, v in got.items()), key=repr) == sorted(((r[0], plain(r[1])) for r in messy_rows()), key=repr)


def test_whole_texts_give_the_same_files(spark):
    docs = messy(spark)
    path = work_dir(spark, "token-test")
    token_file.write_ids(docs, path, JSON, 1)
    assert rows_of(token_file.read_ids(spark, path), "start", "n_tokens") == rows_of(
        token_file.read_ids(spark, written(spark, docs)), "start", "n_tokens"
    )


def test_a_frequent_key_goes_to_many_parts(spark):
    layout = token_file.Layout(part=200)
    docs = spark.range(900).selectExpr("if(id % 3 = 0, 5, id) AS doc_id", "'one two three' AS text")
    path = written(spark, docs, layout=layout)
    parts = spark.read.parquet(f"{path}/blocks").select("part", F.explode("pieces.doc_id").alias("k")).filter("k = 5").groupBy("part").count()
    assert parts.count() > 4 and parts.agg(F.max("count")).first()[0] < 150
    got = token_file.read_ids(spark, path, layout).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got) and len(got) == 900


def test_no_documents_and_one_id(spark):
    assert token_file.read_ids(spark, written(spark, empty(spark))).collect() == []
    one = spark.createDataFrame([(3, None), (1, "")], "doc_id long, text string")
    assert rows_of(token_file.read_ids(spark, written(spark, one)), "doc_id", "start", "n_tokens") == [(1, 0, 1), (3, 1, 1)]


def test_pieces_joined_in_the_end_and_not(spark):
    path = written(spark, messy(spark), layout=token_file.Layout(block=100))
    several = spark.read.parquet(f"{path}/blocks").select(F.explode("pieces").alias("p")).filter("p.piece > 0").count()
    assert several > 100


def huffman_bits(counts):
    heap = list(counts)
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=2, max_size=60))
def test_lengths_without_a_tight_limit_are_huffmans(counts):
    counts = np.array(counts)
    lengths = token_file.code_lengths(counts, 40)
    assert int((counts * lengths).sum()) == huffman_bits(counts.tolist())


def least_bits(counts, limit):
    """The least cost of lengths that fulfil Kraft's equality, by trying all of them."""
    best = None
    for lengths in itertools.product(range(1, limit + 1), repeat=len(counts)):
        if sum(2.0**-x for x in lengths) <= 1:
            cost = sum(c * x for c, x in zip(counts, lengths, strict=True))
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(1, 200), min_size=2, max_size=6))
def test_limited_lengths_are_the_best(counts):
    lengths = token_file.code_lengths(np.array(counts), 3)
    assert lengths.max() <= 3 and sum(2.0**-x for x in lengths) <= 1
    assert int((np.array(counts) * lengths).sum()) == least_bits(counts, 3)


def test_codes_are_canonical_and_no_prefix_of_another():
    ids, counts = np.arange(0, 300, 3), np.arange(1, 101) ** 3
    lengths = token_file.code_lengths(counts, 9)
    order, codes = token_file.canonical_codes(ids, lengths)
    text = [format(c, f"0{n}b") for c, n in zip(codes.tolist(), lengths[order].tolist(), strict=True)]
    assert not any(b.startswith(a) for a, b in itertools.permutations(text, 2))
    assert text == sorted(text) and [len(t) for t in text] == sorted(len(t) for t in text)
    with pytest.raises(ValueError):
        token_file.code_lengths(np.ones(9), 3)


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=300))
def test_checksums_join(a, b):
    assert token_file.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aBcé ßİ\n\t\r\x0b\x0c\x1c\x85\xa0 ́'12.!<|endoftext|>ſKΣς中"), max_size=60) | st.text(max_size=60))
def test_words_give_the_ids_of_whole_texts(text):
    assert encoded(text) == plain(text)


def test_words_of_the_corpus(spark):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    for text in texts:
        assert encoded(text) == plain(text)
    assert encoded(texts[0], "<u4") == plain(texts[0])


def test_special_tokens_inside_texts():
    for text in ("<|ENDOFTEXT|> A<|EndOfText|>", "it's it'S I'LL'd don't's ain't.'ve x'tis", "Ça, n'été! ÀÉÎÕÜ ªº µ ÿŸ ß ŒÆ ñ·l a1b2 A$$$ a.b,c", "a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "x <|endof text|>"):
        assert encoded(text) == plain(text)
