"""Ranked search against a plain version in whole numbers, and against its SQL."""

import math
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import queries, search

KIND, ITEMS = "doc_id long, text string, source string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def plain(docs, items, k=10):
    """Every document against every item."""
    held = [(i, Counter(w), len(w)) for i, t, *_ in docs if (w := words(t))]
    count, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * count) // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if score > 0:
                scored.append((-score, i is not None, i))
        out += [(str(item), r, str(i), -s) for r, (s, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def made(n=300, seed=4):
    rnd = random.Random(seed)
    vocabulary = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(4000)] + ["The", "été", "it's", "日本", "A_b"]
    docs = [(rnd.randrange(-50, 10**12) if i % 3 else i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 4, 30, 200]))), "s") for i in range(n)]
    docs += [(7000, None, "s"), (7001, "", "s"), (7002, "?! _ \n", "s"), (7003, "the " * 30000, "s"), (7004, "alpha beta", "s"), (7004, "alpha beta", "s"), (7005, "ALPHA beta", "s"), (None, "alpha beta", "s"), (7006, "a\u0000b Ünï", "s")]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 5, 40])))) for i in range(25)] + [(90, None), (91, " ,"), (92, "alpha alpha BETA"), (92, "alpha alpha BETA"), (None, "the été"), (93, "nowhere")]
    return docs, items


@pytest.mark.parametrize(("shard", "block", "small"), [(1 << 21, 50_000, 200_000), (150, 40, 0)])
def test_equals_plain_version(spark, monkeypatch, shard, block, small):
    import cadastra.llm.common as common

    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(common, "SMALL", small)
    docs, items = made()
    # SHARD is read in worker processes, which don't see the patch: documents are spread to as many tasks instead
    table = spark.createDataFrame(docs, KIND).repartition(2 if small else 24).withColumns({c: F.lit(1) for c in ("id", "t", "term", "shard", "n", "w", "block")})
    got = search.search(search.build(table), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in got) == plain(docs, items)


def test_rows_of_a_shard():
    rnd, docs, one = random.Random(9), {}, search.Shard()
    for i in rnd.sample(range(1000), 40):
        docs[i] = [rnd.choice([b"a", b"b", b"c", b"zz"]) for _ in range(rnd.randrange(1, 900))]
        one.add(i, docs[i])
    head, *rest = [r for rows in one.rows(5) for r in rows]
    assert head[:4] == (5, None, 40, sum(map(len, docs.values()))) and head[5] == sorted(docs) and search.unpacked(head[4]).tolist() == [len(docs[i]) for i in sorted(docs)]
    assert [r[1] for r in rest] == sorted(one.codes)
    for _, term, n, _, data, _ in rest:
        numbers = search.unpacked(data)
        held = {head[5][d]: c for d, c in zip(np.cumsum(numbers[::2]), numbers[1::2], strict=True)}
        assert held == {i: w.count(term) for i, w in docs.items() if term in w} and len(held) == n


def test_numbers_of_any_length():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**62, 5])
    data, at = search.packed(values)
    assert search.unpacked(data).tolist() == values.tolist() and at[-1] == len(data) and search.unpacked(b"").tolist() == []


def test_merge_equals_sums():
    """Bounds never lose a document, ties go to the first."""
    rnd = random.Random(2)
    for _ in range(300):
        lists, total = [], Counter()
        for _ in range(rnd.randrange(1, 8)):
            docs = sorted(rnd.sample(range(60), rnd.randrange(1, 40)))
            adds = [rnd.choice([1, 5, 5, 100]) * rnd.choice([1, 1, 7]) for _ in docs]
            total.update(dict(zip(docs, adds, strict=True)))
            lists.append((docs, adds, max(adds)))
        k = rnd.choice([1, 3, 10])
        assert search.best(lists, k) == [(s, d) for d, s in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:k]]


def test_empty(spark):
    docs, items = made(20)
    none = spark.createDataFrame([], KIND)
    assert search.search(search.build(none), spark.createDataFrame(items, ITEMS)).count() == 0
    assert search.search(search.build(spark.createDataFrame(docs, KIND)), spark.createDataFrame([], ITEMS)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = queries.op11_ranked_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect()
    want = con.sql(f"SELECT item_id, rank, doc_id, score FROM ({queries.oracle_sql()['op11_ranked_search']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 200
