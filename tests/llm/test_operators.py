"""Training-data operators on small fixtures: brute force, round trips, held-out accuracy, and edge cases."""

import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadastra.llm import bpe, chat, common, decontaminate, flac, language_id, licenses, line_dedup, sharding, simhash, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the of and to in is that for with was this from have are which".split(), "de": "der die und das nicht ein von mit sich auf für ist über wird".split(), "fr": "le la les des une et est dans pour que qui avec être été".split(), "es": "el los las una que por con para del está como más pero sus".split()}


def make_docs(n=400, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        text = " ".join(rnd.choice(WORDS[lang]) + rnd.choice(["", "", "x", "ing" if lang == "en" else "en"]) for _ in range(rnd.choice([3, 20, 60])))
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    return rows


EDGES = [(1000, None, None, None, None), (1001, "", "en", "s0", 0), (1002, " \n\n ", "en", "s0", 4), (1003, "?!? 123", "en", None, 7), (1004, "Ünï\u0000code İΣς\n日本語", "de", "s1", 10), (1005, "word " * 20000, "en", "s2", 100000), (1005, "word " * 20000, "en", "s2", 100000), (None, "no id here", "en", "s0", 10)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs() + EDGES, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """Extra columns with names that operators use inside."""
    return df.withColumns({c: F.lit(1) for c in ("i", "t", "g", "a", "fp", "doc", "pos", "shard", "rank", "n_hit", "keys", "page", "row", "text_", "hits")})


# ---- 1 ----------------------------------------------------------------------
def test_language_held_out(spark, docs):
    model = language_id.fit(docs)
    assert model.top.classes == ["germanic", "romance"] and model.inner["romance"].classes == ["es", "fr"]
    got = language_id.identify(docs, model).join(docs.where("length(text) > 30").select("doc_id", "lang"), "doc_id").where("held_out AND doc_id < 1000").collect()
    assert len(got) > 40 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    for r in language_id.identify(docs, model).collect():
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if r["doc_id"] in (1000, 1001, 1002, 1003):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in WORDS


def test_language_inputs_and_empty(spark, docs, empty):
    model = language_id.fit(docs)
    shuffled = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("q")})
    key = lambda df: sorted((str(r["doc_id"]), r["lang_pred"], r["score"]) for r in language_id.identify(df, model).collect())
    assert key(docs) == key(shuffled) == key(clashing(docs))
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.fit(empty)).collect()} == {"und"}
    only = language_id.fit(docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language_id.identify(docs.where("doc_id < 400"), only).collect()} == {"en"}
    kept = language_id.keep_identified(docs.withColumn("lang", F.when(F.col("doc_id") % 5 > 0, F.col("lang"))), model)
    assert kept.columns == docs.columns and kept.where("doc_id IN (1000, 1001, 1002, 1003)").count() == 0 and kept.where("doc_id < 1000").count() == 400
    assert kept.where("lang IS NULL").count() == 0  # missing ones are filled in
    assert kept.schema == docs.schema
    scores = {r["doc_id"]: r["score"] for r in language_id.identify(docs, model).collect() if r["doc_id"] is not None}
    strict = language_id.keep_identified(docs.where("doc_id IS NOT NULL"), model, 0.8)
    assert {r["doc_id"] for r in strict.collect()} == {i for i, s in scores.items() if s >= 0.8}


def test_language_letters_and_chunks(monkeypatch):
    """A letter is what Unicode calls one; the profile doesn't depend on how the text is cut."""
    import sys
    import unicodedata

    assert all(language_id.has_letter(chr(c)) == unicodedata.category(chr(c)).startswith("L") for c in range(sys.maxunicode + 1))
    assert language_id.LanguageModel(np.eye(2, language_id.WIDTH, dtype=np.float32), ["en", "fr"]).predict(["½²①Ⅷ", "٣ 四", None, "é"])[0][::2] == ["und", "und"]
    rnd = random.Random(2)
    text = "".join(rnd.choice(["the ", "für  ", "é", "x.", " \n ", "  "]) for _ in range(4000))
    whole = language_id.profile(text)
    for chunk in (64, 1000, 4096):
        monkeypatch.setattr(language_id, "CHUNK", chunk)
        assert np.array_equal(language_id.profile(text), whole)


def test_profile_covers_whole_text():
    a, b = "the of and " * 200000, "the of and " * 200000 + "für über " * 50000
    assert np.abs(language_id.profile(a) - language_id.profile(b)).max() > 0.01


# ---- 2 ----------------------------------------------------------------------
def check_shards(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) <= set(range(16))
    sizes = [len(by.get(s, [])) for s in range(16)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards(spark, docs, empty):
    rows = sharding.shard(clashing(docs)).collect()
    check_shards(rows, docs.count())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert sharding.shard(empty).count() == 0


def test_shards_keep_groups_and_split_hot_ones(spark):
    rows = [(i, f"pair {i // 2}") for i in range(600)] + [(600 + i, "hot") for i in range(400)] + [(1000 + i, f"alone {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.shard(df).collect()
    check_shards(got, 1200)
    text, where = dict(rows), {}
    for r in got:
        where.setdefault(text[r["doc_id"]], []).append(r["shard"])
    pairs = [len(set(v)) for k, v in where.items() if k.startswith("pair")]
    assert sum(p > 1 for p in pairs) < 0.35 * len(pairs)  # unlinked hashing would cut 15 of 16
    whole = {k: v for k, v in where.items() if len(v) > 1}
    plain = sum(len(set(v)) - 1 for v in whole.values()) / sum(len(v) - 1 for v in whole.values())
    assert sharding.cut_share(sharding.shard(df)) == pytest.approx(plain)
    hot = sorted(where["hot"].count(k) for k in range(16))
    assert sum(hot[-4:]) >= 200  # evenly dealt it would be 100


def plain_shards(rows, shards=16):
    """Cut links when hashing alone deals the rows, and the fewest that any placement has to cut: a group beyond a shard's size needs several."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(zlib.crc32(str(i).encode()) % shards)
    links = sum(len(v) - 1 for v in groups.values())
    quota = len(rows) // shards
    return sum(len(set(v)) - 1 for v in groups.values()) / links, sum(-(-len(v) // (quota + 1)) - 1 for v in groups.values()) / links


@pytest.mark.parametrize("linked", [0.1, 0.6, 0.9, 1.0])
def test_shards_of_copies_stay_together(spark, linked):
    n = 6000
    rows = [(i, f"pair {i // 2}" if i < linked * n else f"alone {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard(df).cache()
    check_shards(out.collect(), n)
    hashed, least = plain_shards(rows)
    got = sharding.cut_share(out)
    assert hashed > 0.9 and least == 0 and got < 0.25, got


# ---- 3, 7 --------------------------------------------------------------------
@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


NASTY = ["", "a" * 3000, "<|endoftext|>x<|endoftext|>", " \x1c\x1d\x85 ᠎ a​ b", "İΣς K", "don't   we'll  \n\n x", "!" * 700 + "=" * 999, "\n" * 700, " " * 1000 + "x", "日本語" * 300, "x y " * 30000]


def test_encoding_equals_library(theirs):
    enc, rnd = bpe.Encoder(PATH), random.Random(8)
    cases = NASTY + ["".join(rnd.choice(rnd.choice(["ab", "abc ", "the an in re'", "éèx", "0123 ", "=-*", "日本aé \n"])) for _ in range(rnd.choice([5, 50, 900]))) for _ in range(150)]
    for c in cases:
        ids = theirs.encode(c, add_special_tokens=False).ids
        assert enc.encode(c) == ids and enc.count(c) == len(ids)
        d = bpe.Decoder(enc.m)
        assert "".join(d.feed([i]) for i in ids) + d.end() == theirs.decode(ids, skip_special_tokens=False) == c


def test_pre_tokens_equal_library_on_all_code_points(theirs):
    """Letters, numbers, spaces and the rest, alone and beside others, as the library's own classes have them."""
    find = bpe.PreTokens()
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(points), 1024):
        text = "".join(f"{chr(c)}a{chr(c)}1{chr(c)}!" for c in points[lo : lo + 1024])
        assert find(text) == [text[a:b] for _, (a, b) in theirs.pre_tokenizer.pre_tokenize_str(text)], hex(points[lo])


def test_random_unicode_equals_library(theirs):
    enc, rnd = bpe.Encoder(PATH), random.Random(12)
    pick = [lambda: rnd.randrange(32, 127), lambda: rnd.randrange(0x110000), lambda: rnd.randrange(0x3000), lambda: ord(rnd.choice("' s\t\u0558\ua7ce\U00010940"))]
    texts = ["".join(chr(c) for c in (rnd.choice(pick)() for _ in range(24)) if not 0xD800 <= c < 0xE000) for _ in range(10000)]
    got = [[] for _ in texts]
    for k, ids in enc.blocks(texts):
        got[k] += ids.tolist()
    assert got == [x.ids for x in theirs.encode_batch(texts, add_special_tokens=False)]


def test_both_forms_of_the_transducer_equal_merging():
    m, rnd = bpe.Merges(PATH), random.Random(5)
    words = [bytes(rnd.choice(b"abcdehinorst \xc3\xa9\xe6\x97") for _ in range(rnd.randrange(1, 60))) for _ in range(3000)] + [b"a" * 128, b" " * 100, bytes(range(256))]
    merged = m.merge_many(words)
    assert m.transduce(words) == merged
    for w, ids in list(zip(words, merged, strict=True))[-400:]:
        s = bpe.StreamEncoder(m)
        assert np.array(s.feed(w) + s.end(), np.int32).tobytes() == ids and m.merge(w) == np.frombuffer(ids, np.int32).tolist()


def test_stream_memory_is_one_window():
    m = bpe.Merges(PATH)
    s, ids, most = bpe.StreamEncoder(m), [], 0
    rnd = random.Random(2)
    text = bytes(rnd.choice(b"abcdefgh") for _ in range(20000))
    for at in range(0, len(text), 7):
        ids += s.feed(text[at : at + 7])
        most = max(most, len(s.buf))
    ids += s.end()
    assert b"".join(m.bytes_of[i] for i in ids) == text and ids == bpe.Merges.merge(m, text[:300])[:0] + ids
    assert m.lookahead == 128 and most <= 8 * m.lookahead
    assert Tokenizer.from_file(PATH).encode(text.decode(), add_special_tokens=False).ids == ids


def test_decoder_holds_back_unfinished_characters():
    m = bpe.Merges(PATH)
    d = bpe.Decoder(m)
    first, rest = m.byte_id["é".encode()[0]], m.byte_id["é".encode()[1]]
    assert d.feed([first]) == "" and d.feed([rest]) == "é"
    assert d.feed([first]) + d.feed([m.byte_id[65]]) + d.end() == "�A"


def test_round_trip(spark, docs, empty, theirs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in bpe.round_trip(clashing(docs), PATH).collect():
        text = texts[r["doc_id"]] or ""
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    back = {r["doc_id"]: r["text"] for r in bpe.decode_ids(bpe.encode_ids(docs, PATH), PATH).collect()}
    assert back == {k: v or "" for k, v in texts.items()}
    assert bpe.round_trip(empty, PATH).count() == 0


def test_histogram(spark, docs, empty, theirs):
    lens = [len(theirs.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    hist = token_counts.histogram(token_counts.lengths(docs, PATH)).cache()
    rows = {r["n_tokens"]: r for r in hist.collect()}
    assert set(rows) == set(lens)
    for k, r in rows.items():
        assert (r["n_docs"], r["docs_at_least"]) == (lens.count(k), sum(x >= k for x in lens))
        assert (r["tokens_at_least"], r["tokens_below"], r["truncated_total"]) == (sum(x for x in lens if x >= k), sum(x for x in lens if x < k), sum(min(x, k) for x in lens))
        assert r["at_most"] == pytest.approx(sum(x <= k for x in lens) / len(lens))
    assert token_counts.truncated_total(hist, 17) == sum(min(x, 17) for x in lens)
    assert token_counts.quantile(hist, 0.5) == sorted(lens)[(len(lens) + 1) // 2 - 1]
    assert token_counts.histogram(token_counts.lengths(empty, PATH)).count() == 0


# ---- 4 ----------------------------------------------------------------------
def words_of(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_hits(docs, bench, size=10):
    out = []
    for i, text in docs:
        w, hit, items = words_of(text), set(), set()
        for item, t in bench:
            b = words_of(t)
            n = min(size, len(b))
            for at in range(max(0, len(b) - size) + 1) if b else ():
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == b[at : at + n]:
                        hit |= set(range(k, k + n))
                        items.add(str(item))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination(spark, empty):
    rnd = random.Random(11)
    vocab = ["alpha", "Beta", "gamma", "délta", "ÉPSILON", "σας", "eta", "theta1"]
    bench = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 10, 14])))) for k in range(12)] + [(50, None), (51, " ?! "), (52, "ha " * 12), (52, "ha " * 12), (None, "only null item words here")]
    docs = [(k, ", ".join([" ".join(rnd.choice(vocab).upper() if rnd.random() < 0.2 else rnd.choice(vocab) for _ in range(rnd.randrange(30))), rnd.choice([b or "" for _, b in bench]).swapcase() if rnd.random() < 0.3 else rnd.choice([b or "" for _, b in bench])])) for k in range(80)]
    docs += [(900, None), (901, ""), (902, "HA-" * 30), (902, "clean words"), (903, "Only null  item; words HERE")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    known = [(i, t) for i, t in bench if i is not None]
    got = decontaminate.report(clashing(frame), spark.createDataFrame(known, "item_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_hits(docs, known)
    table = spark.createDataFrame(bench, "item_id long, text string")
    kept = decontaminate.keep_clean(clashing(frame), table)
    assert kept.columns == clashing(frame).columns
    bad = {r[0] for r in brute_hits(docs, bench) if r[5]}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs if i not in bad} | {902}
    assert decontaminate.report(frame, spark.createDataFrame([], "item_id long, text string")).where("contaminated").count() == 0
    assert decontaminate.report(empty, table).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "red green blue red"), (2, "red x x x x blue")], "doc_id long, text string")
    vocab = spark.createDataFrame([("red", 1), ("blue", 2)], "w string, vid long").select(F.xxhash64("w").alias("h"), "vid")
    index = decontaminate.index(frame, vocab)
    assert sorted(tuple(r) for r in decontaminate.near(index, 1, 2, 2).collect()) == [(1, 0, 2), (1, 3, 2)]


# ---- 5 ----------------------------------------------------------------------
def brute_fingerprint(text):
    import re

    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum((sum(h >> b & 1 for h in hs) * 2 > len(hs)) << b for b in range(64)) if hs else 0


def brute_components(items, linked):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i][1], items[j][1]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(items):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [(d, least[find(i)]) for i, (d, _) in enumerate(items)]


def test_fingerprints_and_components(spark, docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None]
    rnd = random.Random(3)
    base = [rnd.choice(WORDS["en"]) + str(rnd.randrange(500)) for _ in range(900)]
    for k in range(40):
        w = list(base)
        w[rnd.randrange(900)] = f"edit{k}"
        rows.append((2000 + k, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = simhash.near_duplicates(clashing(frame)).select("doc_id", simhash.hex_of().alias("f"), "component_id").collect()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert {(r["doc_id"], r["f"]) for r in got} == {(i, f"{p:016x}") for i, p in prints.items()}
    want = brute_components([(i, prints[i]) for i, _ in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted(want)
    assert simhash.near_duplicates(empty).count() == 0


def test_tree_misses_nothing():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64).reshape(-1, 1)
    near = x[:500] ^ (np.uint64(1) << rng.integers(0, 64, (500, 1), dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, (500, 1), dtype=np.uint64))
    both = np.concatenate([x, near])
    met = set()
    for mask in ((1 << 32) - 1, (1 << 64) - (1 << 32)):
        t = simhash.VantageTree(both[::7], 0, mask, 1, 8)
        assert t.leaves > 20
        rows, leaves = t.route(both)
        by = {}
        for r, leaf in zip(rows.tolist(), leaves.tolist(), strict=True):
            by.setdefault(leaf, set()).add(r)
        met |= {k for k in range(500) if any(k in s and 3000 + k in s for s in by.values())}
    assert met == set(range(500))


def test_large_leaf_is_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 16)
    rows = [(i, (1 << (i % 60)).to_bytes(8, "big")) for i in range(60)]
    distinct = spark.createDataFrame([(bytearray(b),) for _, b in rows], "fp binary")
    edges = simhash.links(distinct, 2, 1)
    assert {bytes(r["root"]) for r in simhash.components(edges).select("root").distinct().collect()} == {(1).to_bytes(8, "big")}


def test_keep_one(spark):
    rnd = random.Random(9)
    text = lambda: [rnd.choice(WORDS["en"]) + str(rnd.randrange(3000)) for _ in range(400)]
    clean = [(k, " ".join(text())) for k in range(60)]
    rows = list(clean)
    for k in range(20):
        w = clean[k][1].split()
        for _ in range(5):
            w[rnd.randrange(400)] = "changed"
        rows += [(100 + k, " ".join(w)), (200 + k, clean[k][1])]
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(range(60))


def test_keep_one_goes_by_rows(spark):
    """Repeated and missing ids: a text goes only where a chosen one is like it, and then all its rows do."""
    rnd = random.Random(4)
    a, b, c, d, e = (" ".join(f"{rnd.choice(WORDS['en'])}{rnd.randrange(3000)}" for _ in range(300)) for _ in range(5))
    like = lambda t, k: f"{t} tail{k}"
    rows = [(5, like(a, 1)), (5, b), (3, a), (None, a), (None, like(c, 1)), (None, c), (3, d), (7, d), (3, like(d, 2)), (8, e), (8, e), (9, ""), (10, None), (None, "   ")]
    got = [tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    one_of = lambda *texts: sum(t in texts for _, t in got)
    assert (3, a) in got and one_of(a, like(a, 1)) == 1
    assert (5, b) in got and one_of(c, like(c, 1)) == 1 and one_of(d, like(d, 2)) == 1 and (7, d) not in got
    assert got.count((8, e)) == 2 and one_of("", None, "   ") == 1 and len(got) == 7


def test_keep_one_checks_the_jaccard_similarity(spark):
    """Near texts just below 0.8 stay, those above go."""
    rnd = random.Random(4)
    rows = []
    for k in range(150):
        a = [f"w{rnd.randrange(10**9)}" for _ in range(400)]
        b = list(a)
        for at in rnd.sample(range(2, 398), 3 if k < 20 else (8, 12)[k % 2]):
            b[at] = f"c{rnd.randrange(10**9)}"
        rows += [(k, " ".join(a)), (1000 + k, " ".join(b))]
    sim = {k: simhash.jaccard(*(simhash.shingle_set(rows[2 * k + i][1], 5) for i in (0, 1))) for k in range(150)}
    assert any(0.7 < x < 0.8 for x in sim.values()) and any(0.8 <= x < 0.9 for x in sim.values())
    frame = spark.createDataFrame([*rows, (None, None), (7, "")], "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.keep_one(frame).collect()}
    assert kept >= {k for k, _ in rows if k < 1000} and {k for k in sim if 1000 + k not in kept} == {k for k in sim if sim[k] >= 0.8}


def similar_pairs(rnd, n, words=120):
    """Texts and, for each, one with some words changed, for similarities on both sides of 0.8."""
    rows = []
    for k in range(n):
        a = [f"w{rnd.randrange(10**9)}" for _ in range(words)]
        b = list(a)
        for at in rnd.sample(range(words), rnd.randrange(1, 5)):
            b[at] = f"c{rnd.randrange(10**9)}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    return rows


def test_near_dedup_keeps_the_driver_small(spark, monkeypatch):
    """The shards' tables are made in the workers, no closure carries them, and what grows with the texts is merged, not broadcast."""
    sent, plans = [], []
    broadcast, cut = spark.sparkContext.broadcast, simhash.Cut.__init__
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda v: sent.append(v) or broadcast(v))
    monkeypatch.setattr(simhash.Cut, "__init__", lambda self, df, kept=False: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(self, df, kept))
    got = simhash.keep_one(spark.createDataFrame(similar_pairs(random.Random(5), 40), "doc_id long, text string"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert 40 <= got.count() < 80 and not sent
    joins = [line for p in plans for line in p.splitlines() if "Join " in line]
    assert joins and all("strategy=merge" in line or "SortMergeJoin" in line or "strategy=broadcast" in line for line in joins) and "SortMergeJoin" in plans[-1]


@pytest.mark.parametrize("target", [16384, 256, 16])
def test_similar_texts_equal_brute_force_at_any_depth(spark, monkeypatch, target):
    """All links of a similarity of 0.8 or more, and no others, whether the trees have one leaf or thousands; small chunks and classes too."""
    monkeypatch.setattr(simhash, "SHARD_TARGET", target)
    if target == 256:
        monkeypatch.setattr(simhash, "SHARD_ROWS", 200)
        monkeypatch.setattr(simhash, "CLASS_ROWS", 4)
        monkeypatch.setattr(common, "HOT_ROWS", 2)
    rows = similar_pairs(random.Random(target), 1500)
    # chains: each text is similar to the next, the first and the last are not; and one that many copy
    rnd = random.Random(1)
    w = [f"x{rnd.randrange(10**9)}" for _ in range(200)]
    for k in range(30):
        w[6 * k] = f"y{rnd.randrange(10**9)}"
        rows.append((10000 + k, " ".join(w)))
    rows += [(20000 + k, rows[5][1]) for k in range(40)] + [(30000, "a b c d"), (30001, "A  b c d"), (30002, "a b c e"), (30003, None), (30004, " ")]
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    # brute force over pairs that share a shingle, as others have similarity 0
    by, parent = {}, {i: i for i, _ in rows}
    sets = {i: frozenset(simhash.shingle_set(t, 5).tolist()) for i, t in rows}
    for i, s in sets.items():
        for h in s or {None}:
            by.setdefault(h, []).append(i)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for pair in {(a, b) for v in by.values() for x, a in enumerate(v) for b in v[x + 1 :]}:
        a, b = (sets[i] for i in pair)
        if len(a & b) >= 0.8 * len(a | b):
            x, y = find(pair[0]), find(pair[1])
            parent[max(x, y)] = min(x, y)
    want = {i: find(i) for i, _ in rows}
    lost = [i for i in want if want[i] != got[i] and got[i] == i]
    assert not [i for i in want if want[i] != got[i] and got[i] != i], "linked below the similarity"
    links = sum(want[i] != i for i in want)
    assert len(lost) <= 0.005 * links, (len(lost), links)


def test_forest_and_blocks():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, (400, 5), dtype=np.uint64)
    x[200:] = x[:200] ^ (rng.integers(0, 1 << 63, (200, 5), dtype=np.uint64) & rng.integers(0, 1 << 63, (200, 5), dtype=np.uint64) & rng.integers(0, 1 << 63, (200, 5), dtype=np.uint64))
    v = x[:, 0].astype(np.int64) & 15
    for radius in (0, 1):
        for side in (None, rng.integers(0, 2, 400).astype(bool)):
            home = rng.integers(0, 2, 400).astype(bool)
            want = simhash.Forest(400)
            for a in range(400):
                for b in range(a):
                    if (home[a] or home[b]) and (side is None or side[a] != side[b]) and int(v[a] ^ v[b]).bit_count() <= radius and int(np.bitwise_count(x[a] ^ x[b]).sum()) <= 100:
                        want.join(np.array([a]), np.array([b]))
            found, got = simhash.near_in_block(x, v, home, side, 100, radius), simhash.Forest(400)
            got.join(found[:, 0], found[:, 1])
            assert np.array_equal(got.root, want.root) and len(found) == len(want.found()) and len(found) > 5


# ---- 6 ----------------------------------------------------------------------
def test_flac_round_trip(spark, docs, empty):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stored = flac.store(clashing(docs)).cache()
    for r in flac.read(stored).collect():
        n, payload = flac.payload_of(texts[r["doc_id"]])
        assert len(payload) % 576 == 0 and payload
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    media = {r["doc_id"]: bytes(r["media"]) for r in stored.collect()}
    for i in list(media)[:40]:
        samples = flac.decode_stream(media[i])
        assert (samples.astype(np.int8).view(np.uint8) ^ 0x80).tobytes() == flac.payload_of(texts[i])[1]
    blocks = flac.pcm_blocks(stored.where("doc_id = 1005").limit(1), frames=10).orderBy("block").collect()
    assert [b["sample_offset"] for b in blocks] == [5760 * k for k in range(len(blocks))]
    assert b"".join(bytes(b["pcm"]) for b in blocks) == flac.payload_of(texts[1005])[1]
    assert flac.read(flac.store(empty)).count() == 0


def test_flac_frame_kinds_and_damage():
    smooth = bytes(int(128 + 100 * np.sin(k / 30)) for k in range(576 * 3))
    rnd = random.Random(1)
    noise = bytes(rnd.randrange(256) for _ in range(576))
    for data in (smooth, noise, b"\x07" * 576, smooth + noise + b"\x00" * 576, smooth * 60):
        (s,) = flac.streams([data])
        assert flac.read_back([s]) == [data]
        assert (flac.decode_stream(s).astype(np.int8).view(np.uint8) ^ 0x80).tobytes() == data
    assert len(flac.streams([smooth])[0]) < len(smooth)
    good = flac.streams([smooth])[0]
    for at in (-3, -200, len(good) - 600):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            flac.read_back([bytes(bad)])


def test_flac_seek_table_of_some_frames(monkeypatch):
    """Past the limit of a seek table the frames between its points are found by their headers, side by side as ever."""
    rnd = np.random.default_rng(4)
    smooth = (np.cumsum(rnd.integers(-2, 3, flac.FRAME * 3000)) & 63).astype(np.uint8).tobytes()
    noise = rnd.integers(0, 256, flac.FRAME * 40, dtype=np.uint8).tobytes()
    monkeypatch.setattr(flac, "TABLE", 18 * 7)
    some = flac.streams([smooth, noise])
    assert all(0 < len(flac.metadata(s)[1]) < 8 for s in some)
    plain = flac.decode_stream
    monkeypatch.setattr(flac, "decode_stream", lambda s: pytest.fail("read front to back"))
    assert flac.read_back(some) == [smooth, noise]
    monkeypatch.setattr(flac, "decode_stream", plain)
    # the next frame's header stands among the samples
    head = bytes(b ^ 0x80 for b in flac.frame_head(8))
    tricky = noise[: 7 * flac.FRAME + 30] + head + noise[7 * flac.FRAME + 30 + len(head) :]
    (s,) = flac.streams([tricky])
    assert s.count(flac.frame_head(8)) == 2 and flac.read_back([s]) == [tricky]
    bad = bytearray(some[1])
    bad[-300] ^= 4
    with pytest.raises(ValueError):
        flac.read_back([bytes(bad)])


def test_flac_reads_lpc_and_partitions():
    """A hand-made frame: LPC of order 1 (coefficient 1), two Rice partitions, one of them escaped."""
    x = [10, 11, 13, 12, 12, 14, 13, 15] * 24
    bits = ""
    put = lambda v, n: format(v & (1 << n) - 1, f"0{n}b")
    bits += put(0x7FFC, 15) + "0" + put(1, 4) + put(4, 4) + put(0, 4) + put(1, 3) + "0" + put(0, 8)
    head = bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))
    crc8 = int(flac.checksums(np.frombuffer(head, np.uint8), np.array([0]), np.array([len(head)]), 0x07, 8)[0])
    sub = "0" + put(32, 6) + "0" + put(x[0], 8) + put(1, 4) + put(0, 5) + put(1, 2) + put(0, 2) + put(1, 4)
    res = [b - a for a, b in zip(x, x[1:])]
    fold = lambda r: (r << 1) if r >= 0 else -2 * r - 1
    sub += put(1, 4) + "".join("0" * (fold(r) >> 1) + "1" + put(fold(r), 1) for r in res[:95])
    sub += put(15, 4) + put(6, 5) + "".join(put(r, 6) for r in res[95:])
    body = bits + put(crc8, 8) + sub
    body += "0" * (-len(body) % 8)
    data = bytes(int(body[k : k + 8], 2) for k in range(0, len(body), 8))
    crc = int(flac.checksums(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])
    info = bytes(10) + (8000 << 44 | 7 << 36 | len(x)).to_bytes(8, "big") + bytes(16)
    stream = b"fLaC\x80" + len(info).to_bytes(3, "big") + info + data + crc.to_bytes(2, "big")
    assert flac.decode_stream(stream).tolist() == x


# ---- 8 ----------------------------------------------------------------------
def test_chat_round_trip(spark):
    texts = ["plain", r"\### Assistant: </turn> ok", " </turn>\n### user: x", "", None, "a\\\\b#<:", "\n\n", "日本 # \\"]
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant", "sys:tem", None]), rnd.choice(texts)) for c in (1, 2, 3, None) for t in range(9)] + [(4, 0, "assistant", r"x\#")] * 2 + [(5, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(70)]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    plan = chat.conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = chat.conversations(df.repartition(4)).select("tree", "formatted", chat.parsed("formatted").alias("turns"), chat.under_loss("formatted", "loss").alias("loss")).collect()
    assert len(got) == 6
    for r in got:
        mine = sorted([(t, a or "", x or "") for c, t, a, x in rows if c == r["tree"]])
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(a, x) for _, a, x in mine]
        assert r["loss"] == "".join(x for _, a, x in mine if a == "assistant")
        assert r["formatted"].count(chat.END) == len(mine)
    assert chat.conversations(df.limit(0)).count() == 0


def test_reply_trees(spark):
    rnd = random.Random(6)
    rows = []
    for tree in range(5):
        for m in range(40):
            rows.append((tree, m, rnd.randrange(m) if m else None, "user", f"m{m}", float(rnd.randrange(5))))
    df = spark.createDataFrame(rows, "tree long, msg long, parent long, role string, text string, score double")
    info = {(t, m): (p, s) for t, m, p, _, _, s in rows}

    def path(t, m):
        out = []
        while m is not None:
            out.append(m)
            m = info[t, m][0]
        return out[::-1]

    for k in (1, 3):
        got = {}
        for r in chat.best_paths(df, k).collect():
            got.setdefault((r["tree"], r["branch"]), []).append((-r["up_by"], r["msg"]))
        for t in range(5):
            leaves = [m for m in range(40) if not any(info[t, c][0] == m for c in range(40))]
            ranked = sorted(leaves, key=lambda m: (-sum(info[t, x][1] for x in path(t, m)), m))[:k]
            assert [[m for _, m in sorted(got[t, b + 1])] for b in range(k)] == [path(t, m) for m in ranked]
    # repeated rows change nothing; a message whose parent is missing is a root
    twice = df.unionByName(df.withColumns({"text": F.lit("z"), "role": F.lit("zz"), "score": F.lit(9.0)})).repartition(3)
    both = [chat.trees(x).select("tree", "branch", "formatted", "loss").collect() for x in (df, twice)]
    assert sorted(map(tuple, both[0])) == sorted(map(tuple, both[1])) and len(both[0]) == 5
    many = spark.createDataFrame([(1, k, k - 1 if k else None, "user", "a", 1.0) for k in range(8)] * 2, df.schema)
    assert sorted((r["msg"], r["up_by"]) for r in chat.best_paths(many).collect()) == [(k, 7 - k) for k in range(8)]
    lost = spark.createDataFrame([(1, 5, 4, "user", "a", 1.0), (1, 6, 5, "user", "b", 1.0), (1, 9, 77, None, None, None), (None, 1, None, "user", "n", 1.0), (None, 2, 1, "user", "m", 1.0)], df.schema)
    assert sorted(((r["tree"], r["msg"], r["up_by"]) for r in chat.best_paths(lost, 5).collect()), key=str) == sorted([(1, 5, 1), (1, 6, 0), (1, 9, 0), (None, 1, 1), (None, 2, 0)], key=str)
    tie = spark.createDataFrame([(1, 1, None, "user", "a", 1.0), (1, 3, 1, "user", "c", 2.0), (1, 2, 1, "user", "b", 2.0)], df.schema)
    assert [r["leaf"] for r in chat.best_paths(tie).where("up_by = 0").collect()] == [2]
    plan = chat.trees(clashing(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    with pytest.raises(ValueError, match="cycle"):
        loop = spark.createDataFrame([(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0)], df.schema)
        chat.best_paths(loop).collect()


# ---- 9 ----------------------------------------------------------------------
def test_license_scan(spark, empty):
    rows = [
        (1, "r/a/LICENSE", licenses.TEMPLATES[1][1]), (2, "r/a/x.py", "code and code"), (3, "r/a/b/c/y.py", "more code\nReleased under the MIT License.\nend"),
        (4, "r/q/z.py", "nothing"), (5, "r/a/b/w.py", None), (6, None, "no path"), (7, "r/a/b/LICENSE", "Licensed under CC BY-NC 4.0."), (8, "r/a/b/deep/er/v.py", "words"), (9, "r/a/b/v.py", "Licensed under CC BY 4.0."),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert (got[2]["license"], got[2]["basis"], got[2]["inherited_from"]) == ("Apache-2.0", "inherited", "r/a")
    assert (got[3]["license"], got[3]["basis"]) == ("MIT", "header")
    assert (got[4]["license"], got[4]["basis"], got[6]["license"]) == (None, "none", None)
    assert got[7]["license"] == "CC-BY-NC-4.0" and got[9]["license"] == "CC-BY-4.0"
    assert (got[8]["license"], got[8]["inherited_from"]) == ("CC-BY-NC-4.0", "r/a/b")
    assert got[5]["header_score"] == 0 and got[5]["license"] == "CC-BY-NC-4.0"
    assert licenses.license_scan(empty.withColumn("path", F.lit("a"))).count() == 0


def test_license_cosine_equals_dense():
    df, total = {"the": 900, "license": 50, "under": 400, "mit": 3}, 1000
    s = licenses.Scanner(df, total)
    idf = lambda w: np.log((1 + total) / (1 + (df.get(w, 0) if w in s.idf else 0))) + 1
    for text in ("Released under the MIT License.", "the story of a license under the sun", "nothing here", "released released under MIT"):
        def vec(t):
            out = {}
            for w in licenses.tokens(t):
                out[w] = out.get(w, 0) + idf(w)
            return out

        x = vec(text)
        want = []
        for _, t in licenses.TEMPLATES:
            y = vec(t)
            want.append(sum(x[w] * y.get(w, 0) for w in x) / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())))
        assert s.cosine(licenses.Counter(licenses.tokens(text)))[0] == pytest.approx(max(want))


@pytest.mark.parametrize("share", [0.001, 0.3])
def test_license_words_have_their_own_weight(spark, share):
    """Everyday words on a licence line weigh little, whether they are shipped (0.001 of 2000 documents) or joined (below 0.3)."""
    rnd = random.Random(1)
    everyday = "our project website code this is the and".split()
    rows = [(i, f"s/{i}/x", " ".join([*rnd.sample(everyday, 4), f"w{i}"])) for i in range(1990)]
    rows += [(5000, "s/a/x", "Our project is released under the MIT License."), (5000, "s/b/x", "This website code is licensed under the Apache License, Version 2.0."), (None, "s/c/x", "Our project w1 w2 w3 w4 w5 w6 MIT License.")]
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r["path"]: r for r in licenses.license_scan(frame, share=share).collect()}
    assert len(got) == len(rows) and got["s/a/x"]["header"] == "MIT" and got["s/b/x"]["header"] == "Apache-2.0" and got["s/c/x"]["header"] is None
    df = {}
    for _, _, t in rows:
        for w in set(licenses.tokens(t)):
            df[w] = df.get(w, 0) + 1
    full = licenses.Scanner(df, len(rows))
    for path, text in ((r[1], r[2]) for r in rows[-3:-1]):
        assert got[path]["header_score"] == pytest.approx(full.cosine(licenses.Counter(licenses.tokens(text)))[0], abs=1e-6)


def test_license_wrapped_headers_and_whole_texts(spark):
    rnd = random.Random(3)
    page = lambda: "\n".join(" ".join(rnd.choice(["the", "value", "of", "return", "node", "list", "with"]) + rnd.choice(["", "", str(rnd.randrange(99))]) for _ in range(9)) for _ in range(12))
    gpl = "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n"
    rows = [(i, f"p/{i}/x", page()) for i in range(300)] + [(900, "q/code.py", f"import this\n\n{gpl}\n{page()}")]
    rows += [(1000 + k, f"l{k}/LICENSE", t) for k, (_, t) in enumerate(licenses.TEXTS)] + [(2000 + k, f"l{k}/sub/a.py", page()) for k in range(len(licenses.TEXTS))]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got[900]["header"] == "GPL-3.0" and {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0"} <= {n for n, _ in licenses.TEXTS}
    for k, (name, _) in enumerate(licenses.TEXTS):
        assert got[1000 + k]["file"] == name and (got[2000 + k]["license"], got[2000 + k]["inherited_from"]) == (name, f"l{k}")
    assert all(got[i]["basis"] == "none" for i in range(300))


def plain_scan(rows):
    """Every run of lines and every whole text against every template, with dense vectors; then the nearest directory above."""
    from collections import Counter

    count = [Counter(licenses.tokens(t or "")) for _, _, t in rows]
    df = Counter(w for c in count for w in c)
    idf = lambda w: np.log((1 + len(rows)) / (1 + df[w])) + 1
    vector = lambda c: {w: n * idf(w) for w, n in c.items()}
    norm = lambda v: np.sqrt(sum(x * x for x in v.values()))
    every = [(name, vector(Counter(licenses.tokens(t)))) for name, t in (*licenses.TEMPLATES, *licenses.TEXTS)]
    longest = max(len(licenses.tokens(t)) for _, t in (*licenses.TEMPLATES, *licenses.TEXTS))

    def best(c, many, least):
        v = vector(c)
        scores = [sum(x * t.get(w, 0) for w, x in v.items()) / (norm(v) * norm(t)) if v else 0 for _, t in many]
        k = max(range(len(many)), key=lambda k: (round(scores[k], 12), -k))
        return (scores[k], -k) if scores[k] >= least else (0.0, None)

    out, files = {}, {}
    for (i, path, text), c in zip(rows, count, strict=True):
        lines = [x for line in (text or "").split("\n") if (x := Counter(licenses.tokens(line)))]
        found = (0.0, None)
        for a in range(len(lines)):
            run, size = Counter(), 0
            for b in range(a, len(lines)):
                if b > a and size >= longest:
                    break
                run, size = run + lines[b], size + lines[b].total()
                one = best(run, every[: len(licenses.TEMPLATES)], licenses.HEADER)
                found = max(found, one, key=lambda x: (round(x[0], 12), x[1] if x[1] is not None else -(10**9)))
        whole = best(c, every, licenses.FILE)
        out[i] = [found, whole, path]
        if whole[1] is not None and path is not None:
            at = path.rpartition("/")[0]
            files[at] = min(files.get(at, (1, "", 0)), (-round(whole[0], 6), path, whole[1]))
    answer = {}
    for i, (header, whole, path) in out.items():
        name = lambda x: None if x[1] is None else every[-x[1]][0]
        up, at = None, path
        while up is None and at:
            at = at.rpartition("/")[0]
            up = at if at in files else None
        own = name(header) or name(whole)
        basis = "header" if name(header) else "file" if name(whole) else "inherited" if up is not None else "none"
        answer[i] = (name(header), round(header[0], 6), name(whole), round(whole[0], 6), own or (every[-files[up][2]][0] if up is not None else None), basis, up if own is None else None)
    return answer


def test_license_scan_equals_brute_force(spark):
    rnd = random.Random(8)
    everyday = "the code of this project is and for value return list node under see file".split()
    line = lambda: " ".join(rnd.choice(everyday) for _ in range(rnd.randrange(1, 7)))
    rows = []
    for i in range(160):
        lines = [line() for _ in range(rnd.randrange(1, 6))]
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words = rnd.choice(licenses.TEMPLATES)[1].split()
            at = rnd.randrange(1, len(words) + 1)
            lines.insert(rnd.randrange(len(lines) + 1), "# " + " ".join(words[:at]) + ("\n# " if rnd.random() < 0.5 else " ") + " ".join(words[at:]) + rnd.choice(["", " " + line()]))
        if rnd.random() < 0.2:
            lines = [rnd.choice(licenses.TEMPLATES)[1]]
        depth = rnd.randrange(5)
        rows.append((i, "/".join(["r", *(rnd.choice("ab") for _ in range(depth)), f"f{i}"]) if i % 40 else None, "\n".join(lines) if i % 37 else None))
    rows.append((500, "r/a/f1", licenses.TEXTS[0][1]))
    frame = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3)
    got = {r["doc_id"]: (r["header"], r["header_score"], r["file"], r["file_score"], r["license"], r["basis"], r["inherited_from"]) for r in licenses.license_scan(clashing(frame)).collect()}
    want = plain_scan(rows)
    assert {i: (*v[::2], v[5]) for i, v in got.items()} == {i: (*v[::2], v[5]) for i, v in want.items()}
    assert all(got[i][k] == pytest.approx(want[i][k], abs=2e-6) for i in want for k in (1, 3))
    assert {v[5] for v in got.values()} >= {"header", "inherited", "none"}


# ---- 10 ---------------------------------------------------------------------
def test_line_dedup(spark, empty):
    rows = [(i, f"body {i}\n Cookie notice \n\nshared {i % 3}\nshared {i % 3}", "en", "h1", 30) for i in range(30)]
    rows += [(100 + i, f"Cookie notice\nown {i}", "en", None, 20) for i in range(3)] + [(200, None, "en", "h1", None), (201, "", "en", "h1", 0), (202, "Cookie notice", "en", "h1", 13)]
    df = clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    got = {r["page"]["doc_id"]: r for r in line_dedup.drop_boilerplate(df, 0.5, 5).collect()}
    assert got[4]["text"] == "body 4\n\nshared 1\nshared 1" and (got[4]["n_lines"], got[4]["n_dropped"]) == (5, 1)
    assert got[100]["text"] == "Cookie notice\nown 0"  # too few pages
    assert {r["text"] for r in line_dedup.drop_boilerplate(df, 0.5).where("page.doc_id BETWEEN 100 AND 102").collect()} == {"own 0", "own 1", "own 2"}  # two pages are enough
    assert got[200]["text"] is None and got[200]["n_lines"] == 0 and got[201]["text"] == "" and got[202]["text"] == ""
    clean = line_dedup.cleaned(df, 0.5, 5)
    assert clean.columns == df.columns and clean.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert clean.where("doc_id = 4").first()["n_chars"] == len("body 4\n\nshared 1\nshared 1") and clean.where("doc_id = 100").first()["n_chars"] == 20
    assert line_dedup.drop_boilerplate(empty).count() == 0


# ---- pipeline -----------------------------------------------------------------
def test_pipeline(spark, tmp_path, theirs):
    import corpus_pipeline

    rnd = random.Random(1)
    text = lambda n=120: " ".join(rnd.choice(WORDS["en"]) + str(rnd.randrange(900)) for _ in range(n))
    clean = [(i, text(), "en", f"s{i % 2}", 0) for i in range(60)]
    leak = "one quick brown fox jumps over two lazy dogs while three cats sleep"
    rows = clean + [(100, clean[3][1], "en", "s0", 0), (101, text() + " " + leak + " " + text(), "en", "s1", 0), (102, "123 456 ?!", "en", "s0", 0)]
    rows = [(i, ("Site banner line\n" + t) if s == "s0" else t, lang, s, n) for i, t, lang, s, n in rows]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "decontamination", "bpe"]
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) - {102} == set(range(60))
    for i, t, *_ in clean:
        assert got[i] == hashlib.sha256(t.encode()).hexdigest()


def test_pipeline_equals_brute_force(spark, tmp_path, theirs):
    """Each stage by its definition on all that the one before left; the language model alone is taken as it is."""
    import corpus_pipeline

    rnd = random.Random(31)
    words = lambda n: [rnd.choice(WORDS["en"]) + str(rnd.randrange(900)) for _ in range(n)]
    bench = [(k, " ".join(words(14))) for k in range(6)]
    rows = []
    for i in range(150):
        own, host = words(rnd.choice([3, 40, 90])), f"s{i % 3}" if i % 11 else None
        if i and rnd.random() < 0.3:  # a copy of an earlier one, some words changed
            own = rows[rnd.randrange(len(rows))][1].split("\n")[-1].split()
            for _ in range(rnd.randrange(4)):
                own[rnd.randrange(len(own))] = words(1)[0] if own else None
        if rnd.random() < 0.15:
            own[len(own) // 2 : len(own) // 2] = rnd.choice(bench)[1].split()
        head = "Home | About | Contact\n" if host == "s1" and rnd.random() < 0.8 else ""
        rows.append((i, head + " ".join(own), "en", host, 0))
    rows += [(900, None, "en", "s0", 0), (901, "?? 12 ½", "en", "s0", 0), (902, "", None, "s1", 0), (903, rows[5][1], None, "s2", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    known = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(frame, language_id.fit(frame)).collect()}
    left = {i: (t, host) for i, t, _, host, _ in rows if known[i][0] != "und" and known[i][1] >= language_id.LEAST}
    pages, on = {}, {}
    for t, host in left.values():
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in t.split("\n")} - {""}:
            on[host, line] = on.get((host, line), 0) + 1
    bad = {(host, line) for (host, line), n in on.items() if n >= line_dedup.LEAST and n / pages[host] > line_dedup.RATIO}
    left = {i: "\n".join(x for x in t.split("\n") if not x.strip(" ") or (host, x.strip(" ")) not in bad) for i, (t, host) in left.items()}
    sets = {i: frozenset(simhash.shingle_set(t, 5).tolist()) for i, t in left.items()}
    alike = lambda a, b: not a and not b or bool(a & b) and len(a & b) >= 0.8 * len(a | b)
    items = [(i, sets[i]) for i in left]
    left = {i: left[i] for i, least in brute_components(items, alike) if i == least}
    dirty = {r[0] for r in brute_hits(list(left.items()), bench) if r[5]}
    left = {i: t for i, t in left.items() if i not in dirty}
    assert dirty and len(left) < 120 and bad
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    ids = {i: theirs.encode(t, add_special_tokens=False).ids for i, t in left.items()}
    assert got == {i: (len(ids[i]), hashlib.sha256(",".join(map(str, ids[i])).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in left.items()}


def test_salted_joins_equal_broadcast_ones(spark, monkeypatch):
    """Beyond the bound of a broadcast, hot hosts, directories, words and texts go by salted joins, with the same result."""
    pages = spark.createDataFrame([(i, f"body {i}\nbanner\nx {i % 2}", None if i % 5 == 0 else f"h{i % 2}") for i in range(40)], "doc_id long, text string, source string")
    paths = spark.createDataFrame([(i, f"r/{'a/' * (i % 3)}f{i}" if i % 7 else None, licenses.TEMPLATES[i % 18][1] if i % 6 == 0 else "code words") for i in range(30)], "doc_id long, path string, text string")
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(i, item + " x" * i) for i in range(20)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    run = lambda: [sorted(map(str, df.collect())) for df in (line_dedup.drop_boilerplate(pages), licenses.license_scan(paths), decontaminate.report(docs, bench))]
    before = run()
    monkeypatch.setattr(common, "SMALL", 0)
    assert run() == before


def test_registered():
    from cadastra.llm import queries

    assert [q.split("_")[0] for q in queries.queries()] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries()) and json is not None
