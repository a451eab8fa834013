"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

1. The benchmark's words are counted in the corpus, in tasks first. The counts tell each window's two rarest words, its
   anchors; a window with a word that the corpus lacks is dropped.
2. The index is stored once: postings (term, document, position) of the anchors, in the shared folder. The lists of the
   common words, most of all postings, answer no question and are never written.
3. Postings are moved back by their offset in the item: equal (document, item, shift) means that lists meet. A window is
   a candidate where both of its anchors meet at one shift.
4. Candidates meet their own document once, where the exact phrase is compared and the hit words are counted.

Words are found on a wider fold of case in steps 1 to 3, which only ever adds candidates; step 4 folds A-Z alone.

Defined results: null or wordless text has no words and no hits; a null or wordless item has no windows; repeated items
and rows are separate; a null id joins its own rows; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SMALL, cut, spread_join

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of digits, letters A-Z and all that is not ASCII. Single characters make a bit set, which ranges would not.
WORD = rf"[0123456789{UPPER}{LOWER}\x{{80}}-\x{{10FFFF}}]++"


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def folded(text: Column | str) -> Column:
    """Case folded at least as widely as A-Z, by a fast function; final sigma, whose fold depends on its place, made plain."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def terms(text: Column | str) -> Column:
    """Hashes of the words under the wide fold, in order."""
    return F.transform(F.regexp_extract_all(folded(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def windows(bench: DataFrame, size: int = WINDOW, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(row, item, at, len, phrase, hs): every window with its words under the A-Z fold and their hashes under the wide one."""
    items = bench.select(F.xxhash64(F.col(item_col), F.col(text_col)).alias("row"), F.col(item_col).cast("string").alias("item"), words(text_col).alias("w"), terms(text_col).alias("h")).where(F.size("w") > 0).dropDuplicates(["row", "item"])
    n = F.size("w")
    starts = items.withColumn("len", F.least(n, F.lit(size))).withColumn("at", F.explode(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))))
    cut = lambda c: F.slice(c, F.col("at") + 1, F.col("len"))
    return starts.select("row", "item", "at", "len", F.translate(F.array_join(cut("w"), " "), UPPER, LOWER).alias("phrase"), cut("h").alias("hs"))


def index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored positional index of the vocabulary's terms (h, vid): rows (vid, doc, pos)."""
    return cut(postings_of(docs, vocabulary, id_col, text_col))


def postings_of(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    spread = docs.select(F.col(id_col).alias("doc"), F.posexplode(terms(text_col)).alias("pos", "h"))
    return spread_join(spread, vocabulary, ["h"], vocabulary.count(), ["doc", "pos"]).select("vid", "doc", "pos")


def rarest(places: DataFrame, counts: DataFrame, anchors: int = 2) -> DataFrame:
    """(row, item, at, len, phrase, marks): the offsets in the item of each window's rarest words, by (vid, n); windows that cannot occur are left out."""
    by = spread_join(places, counts, ["vid"], counts.count(), ["row", "at", "off"]).groupBy("row", "item", "at", "len", "phrase").agg(F.sort_array(F.collect_list(F.struct("n", "off"))).alias("o")).where(F.size("o") == F.col("len"))
    return by.select("row", "item", "at", "len", "phrase", F.transform(F.slice("o", 1, anchors), lambda x: x["off"] + F.col("at")).alias("marks"))


def bit_of(mark: Column) -> Column:
    """Marks of a window are fewer than 64 apart, so they never share a bit; others may, which only adds candidates."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(mark, F.lit(64)).cast("int"))


def candidates(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, c): for each document that has any, the places (start, len, phrase, item) where a window's rarest words meet."""
    places = windows(bench, size).select("row", "item", "at", "len", "phrase", F.posexplode("hs").alias("off", "h"))
    vocabulary = cut(places.select("h").distinct().withColumn("vid", F.monotonically_increasing_id()))
    places = cut(spread_join(places, vocabulary, ["h"], vocabulary.count(), ["row", "at", "off"]))
    rare = cut(rarest(places, cut(postings_of(docs, vocabulary, id_col, text_col).groupBy("vid").agg(F.count("*").alias("n")))))
    marked = rare.select("row", F.explode("marks").alias("mark")).distinct()
    anchors = cut(marked.join(places.select("row", (F.col("at") + F.col("off")).alias("mark"), "vid").distinct(), ["row", "mark"]))
    postings = index(docs, cut(vocabulary.join(F.broadcast(anchors.select("vid").distinct()) if anchors.count() <= SMALL else anchors.select("vid").distinct(), "vid", "left_semi").select("h", "vid")), id_col, text_col)
    found = spread_join(postings, anchors, ["vid"], anchors.count(), ["doc", "pos"])
    met = found.groupBy("doc", "row", (F.col("pos") - F.col("mark")).alias("shift")).agg(F.bit_or(bit_of(F.col("mark"))).alias("bits"))
    single = rare.where("len = 1").limit(1).count() > 0
    met = met if single else met.where(F.bit_count("bits") > 1)
    own = rare.withColumn("need", F.aggregate("marks", F.lit(0).cast("long"), lambda a, m: a.bitwiseOR(bit_of(m)))).drop("marks")
    hit = spread_join(met, own, ["row"], rare.count(), ["doc", "shift"]).where((F.col("bits").bitwiseAND(F.col("need")) == F.col("need")) & (F.col("shift") + F.col("at") >= 0))
    return hit.groupBy("doc").agg(F.collect_set(F.struct((F.col("shift") + F.col("at")).alias("start"), "len", "phrase", "item")).alias("c"))


def matched(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row whole, as ``doc_row``, with ``n_words`` and ``hits``: its exact phrase matches (start, len, phrase, item)."""
    cands = candidates(docs, bench, size, id_col, text_col)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc_row"), F.col(id_col).alias("doc_key"))
    both = rows.join(cands, F.col("doc_key").eqNullSafe(F.col("doc")), "left")
    both = both.select("doc_row", "c", F.coalesce(words(F.col("doc_row")[text_col]), F.array().cast("array<string>")).alias("w"))
    exact = F.filter("c", lambda x: F.translate(F.array_join(F.slice(F.col("w"), x["start"] + 1, x["len"]), " "), UPPER, LOWER) == x["phrase"])
    return both.select("doc_row", F.size("w").cast("long").alias("n_words"), F.coalesce(exact, F.array().cast("array<struct<start:int,len:int,phrase:string,item:string>>")).alias("hits"))


def report(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    m = matched(docs, bench, size, id_col, text_col)
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1))))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["item"])))
    out = m.select(F.col("doc_row")[id_col].alias(id_col), "n_words", F.size(covered).cast("long").alias("n_hit"), items.alias("items"))
    return out.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, bench: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, in which no window of the benchmark occurs."""
    return matched(docs, bench, size, id_col, text_col).where(F.size("hits") == 0).select("doc_row.*")


def near(postings: DataFrame, first: int, second: int, within: int) -> DataFrame:
    """Proximity: (doc, a, b) where two terms of the index, by vid, stand at most ``within`` words apart.

    Positions meet by spans of ``within``, never all pairs of a document.
    """
    a = postings.where(F.col("vid") == first).select("doc", F.col("pos").alias("a"), F.explode(F.array(*[F.floor(F.col("pos") / within) + k for k in (-1, 0, 1)])).alias("span"))
    b = postings.where(F.col("vid") == second).select("doc", F.col("pos").alias("b"), F.floor(F.col("pos") / within).alias("span"))
    return a.join(b, ["doc", "span"]).where((F.abs(F.col("a") - F.col("b")) <= within) & (F.col("a") != F.col("b"))).select("doc", "a", "b")
