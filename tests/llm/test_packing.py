"""Packing against a plain version: the library's ids, binary digits, gapless numbers."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastra.llm import common, packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
KIND = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(3)
    out = [(i, " ".join(rnd.choice(["the", "Word,", "l'été.", "don't!", "x" * 70, "日本語", "42", "<|endoftext|>"]) for _ in range(rnd.choice([0, 1, 5, 40, 300])))) for i in range(80)]
    return [(i, t, "en") for i, t in out] + [(900, None, None), (901, "", "en"), (902, " \n\t ", "en"), (903, "word " * 9000, "en"), (903, "word " * 9000, "en"), (None, "no id", "en"), (904, "a\u0000b �", "en")]


def expected(library, text, context):
    ids = library.encode(text or "", add_special_tokens=False).ids + [2]
    out, at = [], 0
    while at < len(ids):
        n = context
        while n > len(ids) - at:
            n //= 2
        out.append((at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()), len(ids)))
        at += n
    return out


@pytest.mark.parametrize("context", [64, 4096])
def test_pieces_equal_plain_version(spark, library, context):
    docs = spark.createDataFrame(texts(), KIND).repartition(5).withColumns({c: F.lit(1) for c in ("id", "t", "part", "nth", "length", "first", "n")})
    got = packing.pack(docs, PATH, context).select("doc_id", "start", "length", F.crc32("ids").alias("crc"), "doc_tokens", "sequence_id", "offset", "bucket").collect()
    want = sorted((str(i), *p) for i, t, _ in texts() for p in expected(library, t, context))
    assert sorted((str(r["doc_id"]), r["start"], r["length"], r["crc"], r["doc_tokens"]) for r in got) == want
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got))) and {r["offset"] for r in got} == {0}
    by_number = [r["length"] for r in sorted(got, key=lambda r: r["sequence_id"])]
    assert by_number == sorted(by_number) and all(1 << r["bucket"] == r["length"] <= context for r in got)


def test_numbers_without_broadcast(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "SMALL", 0)
    docs = spark.createDataFrame(texts(), KIND).repartition(3)
    got = packing.pack(docs, PATH).collect()
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got))) and len(got) == sum(len(expected(library, t, 4096)) for _, t, _ in texts())


def test_empty_and_wrong(spark):
    assert packing.pack(spark.createDataFrame([], KIND), PATH).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(spark.createDataFrame([], KIND), PATH, 1000)
    assert packing.lengths(13, 4) == [4, 4, 4, 1] and packing.lengths(7, 8) == [4, 2, 1] and packing.lengths(8, 8) == [8]


def test_runs_equal_library_on_random_text(library, monkeypatch):
    """White space, marks, contractions, combining signs, special tokens, with memory running over."""
    monkeypatch.setattr(packing, "REMEMBERED", 200)
    rnd, own = random.Random(1), packing.Runs(PATH)
    pools = ["abcXYZ',.;:?! \t\n", "éèÅΣσςİıßſ", "̸̧́각", "\x1c\x85\xa0　​\x00", "0123٣½", "🙂👍🏽'sn't'll"]
    words = [" ", "<|endoftext|>", "don't", "it's.", "I'LL,"]
    for _ in range(4000):
        text = "".join(rnd.choice([rnd.choice(rnd.choice(pools)), rnd.choice(words), chr(rnd.choice([rnd.randrange(0xD800), rnd.randrange(0xE000, 0x110000)]))]) for _ in range(rnd.randrange(30)))
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = common.table(spark, sf, "documents").collect()
    got = queries.op12_packing(spark, sf).collect()
    want = sorted((r["doc_id"], *p) for r in rows for p in expected(library, r["text"], 4096))
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
