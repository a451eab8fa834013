"""Sharding by balanced label propagation: linked documents move towards the shard where most of their group is.

Links are equal texts. A document belongs to an atom, its group and one of ``ATOMS`` hash buckets, and an atom moves as
a whole; so a group that holds a third of all rows is still many small movers, and no task ever holds a group. Each
round joins the atoms with their group's best shard, sums what wants to move by shards and lot, and lets lots in while
the shard's quota lasts (a table of shards times shards times lots, of fixed size, is all that reaches the driver). At the end
documents, unlinked ones first, move from shards over their quota to shards below it, so that counts are at most one
apart; ranks inside a shard are made from counts of hash buckets, so no task holds a shard.

Defined results: null text has size 1, CRC 0 and no links; a null id is placed like any other; repeated rows are
separate documents of one group; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Cut

#: An atom of a group that holds a third of all rows is a twenty-fourth of one of 16 shards.
ATOMS, LOTS, BUCKETS = 128, 64, 64
#: Rows that a window over a bucket of a shard sorts, about.
BUCKET_ROWS = 250_000
#: While groups move, a shard may hold this part of the quota more; the levelling at the end takes it back.
SLACK = 1 / 16


def equal_text_links(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, size, text_crc32 and the key of its text (null: none)."""
    data = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"), F.coalesce(F.crc32(data), F.lit(0)).cast("long").alias("text_crc32"), F.unhex(F.md5(data)).alias("g"))


def propagate(atoms: DataFrame, shards: int, quota: int, rounds: int = 8) -> DataFrame:
    """(g, a, n) with a first shard s, to the same rows with their last shard; no shard ends with more than the quota in linked rows but what it began with."""
    state = Cut(atoms)
    for turn in range(rounds):
        here = {r["s"]: r["n"] for r in state.df.groupBy("s").agg(F.sum("n").alias("n")).collect()}
        free = {s: quota - here.get(s, 0) for s in range(shards)}
        open_shards = [s for s in free if free[s] > 0]
        if not open_shards:
            break
        cells = state.df.groupBy("g", "s").agg(F.sum("n").alias("n"))
        total = cells.groupBy("g").agg(F.max(F.when(F.col("s").isin(open_shards), F.struct("n", (-F.col("s")).alias("o")))).alias("best"), F.max("n").alias("most"), F.sum("n").alias("all"))
        wants = state.df.join(total.select("g", (-F.col("best.o")).alias("t"), F.col("best.n").alias("bn"), "most", "all"), "g")
        # halves of one size meet in the lower shard, or in the one that has room; a small group goes as one lot; a large one, atom by atom. What sits in the group's largest full shard stays.
        lot = F.pmod(F.when(F.col("all") > quota / 64, F.xxhash64("g", "a", F.lit(turn))).otherwise(F.xxhash64("g", F.lit(turn))), F.lit(LOTS)).cast("int")
        own = cells.select("g", "s", F.col("n").alias("cn"))
        wants = wants.join(own, ["g", "s"]).withColumn("go", F.col("t").isNotNull() & (F.col("t") != F.col("s")) & ((F.col("cn") < F.col("bn")) | ((F.col("cn") == F.col("bn")) & ((F.col("s") > F.col("t")) | ~F.col("s").isin(open_shards))))).withColumn("lot", lot)
        wants = Cut(wants.select("g", "a", "n", "s", "t", "go", "lot"))
        # every lot that leaves makes room for others: granted over and over until none fits
        asked = [tuple(r) for r in wants.df.where("go").groupBy("s", "t", "lot").agg(F.sum("n").alias("n")).collect()]
        asked.sort(key=lambda r: (r[2], r[1], r[0]))
        let, fits = [], True
        while fits:
            fits, left = False, []
            for move in asked:
                s, t, lot, n = move
                if n <= free[t]:
                    free[t], free[s], fits = free[t] - n, free[s] + n, True
                    let.append((s * shards + t) * LOTS + lot)
                else:
                    left.append(move)
            asked = left
        if not let:
            wants.drop()
            break
        granted = wants.df.sparkSession.createDataFrame([(x,) for x in let], "move int")  # shards x shards x lots rows at most
        moved = wants.df.withColumn("move", F.when(F.col("go"), (F.col("s") * shards + F.col("t")) * LOTS + F.col("lot"))).join(F.broadcast(granted.withColumn("ok", F.lit(True))), "move", "left")
        goes = F.coalesce("ok", F.lit(False))
        new = Cut(moved.select("g", "a", "n", F.when(goes, F.col("t")).otherwise(F.col("s")).alias("s")))
        wants.drop()
        state.drop()
        state = new
    return state.df


def ranked(rows: DataFrame, order: list) -> tuple[DataFrame, dict[int, int]]:
    """Adds ``rank``, gapless from 0 inside each ``shard``: rows of a bucket are numbered by a window, buckets by their counts."""
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).collect()
    before, total = [], {}
    for r in sorted(counts, key=lambda r: (r["shard"], r["bucket"])):
        before.append((r["shard"], r["bucket"], total.get(r["shard"], 0)))
        total[r["shard"]] = total.get(r["shard"], 0) + r["n"]
    spark = rows.sparkSession
    offsets = spark.createDataFrame(before, "shard int, bucket int, before long")  # a row for each bucket, of about ``BUCKET_ROWS`` rows or one in 128 of a shard
    window = Window.partitionBy("shard", "bucket").orderBy(*order)
    return rows.withColumn("in_bucket", F.row_number().over(window) - 1).join(F.broadcast(offsets), ["shard", "bucket"]).withColumn("rank", F.col("before") + F.col("in_bucket")).drop("in_bucket", "before"), total


def cut_share(placed: DataFrame) -> float:
    """The share of links that the shards cut, from ``shard``'s rows: a group of n equal texts counts n - 1 links, and is whole in as many pieces as shards hold it. 0 without links."""
    cells = placed.where("size > 1").groupBy("size", "text_crc32", "shard").agg(F.count("*").alias("n"))
    groups = cells.groupBy("size", "text_crc32").agg(F.sum("n").alias("n"), F.count("*").alias("pieces")).where("n > 1")
    got = groups.agg(F.sum(F.col("n") - 1).alias("links"), F.sum(F.col("pieces") - 1).alias("cut")).first()
    return got["cut"] / got["links"] if got["links"] else 0.0


def shard(docs: DataFrame, shards: int = 16, rounds: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law (``rows``: counts at most one apart), shard, slot, grown_shard (null)."""
    base = Cut(equal_text_links(docs, id_col, text_col).withColumn("a", F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(ATOMS)).cast("int"))).df
    n = base.count()
    # rows of a text meet as counts of its atoms, of which there are ``ATOMS`` at most, however many rows it has
    atoms = Cut(base.where(F.col("g").isNotNull()).groupBy("g", "a").agg(F.count("*").alias("n")))
    linked = atoms.df.groupBy("g").agg(F.sum("n").alias("c")).where("c > 1").select("g")
    movers = atoms.df.join(linked, "g", "left_semi").withColumn("s", (F.col("a") % shards).cast("int"))
    quota = n // shards
    placed = Cut(propagate(movers, shards, quota + max(1, int(quota * SLACK)), rounds).select("g", "a", F.col("s").alias("to"))).df
    atoms.drop()
    rows = base.join(placed, ["g", "a"], "left").withColumn("shard", F.coalesce("to", (F.col("a") % shards).cast("int")))
    # buckets of unlinked rows come first: they are the first to move
    buckets = max(BUCKETS, -(-n // (shards * BUCKET_ROWS)))
    spread = F.pmod(F.xxhash64(F.col(id_col), F.lit(9)), F.lit(buckets)).cast("int")
    rows = Cut(rows.select(id_col, "size", "text_crc32", "shard", (spread + F.when(F.col("to").isNull(), 0).otherwise(buckets)).alias("bucket")))
    rows_ranked, total = ranked(rows.df, [F.col(id_col), F.col("text_crc32"), F.col("size")])
    want = {s: n // shards + (k < n % shards) for k, s in enumerate(sorted(range(shards), key=lambda s: (-total.get(s, 0), s)))}
    over = [(s, total.get(s, 0) - want[s]) for s in range(shards) if total.get(s, 0) > want[s]]
    holes = [(s, total.get(s, 0), want[s] - total.get(s, 0)) for s in range(shards) if total.get(s, 0) < want[s]]
    surplus, number = F.lit(0), F.lit(0)
    past = 0
    for s, extra in over:
        surplus = F.when(F.col("shard") == s, F.lit(extra)).otherwise(surplus)
        number = F.when(F.col("shard") == s, F.lit(past)).otherwise(number)
        past += extra
    at, to, slot, past = F.col("number"), F.col("shard"), F.col("rank") - F.col("surplus"), 0
    moves = F.col("rank") < F.col("surplus")
    for s, start, room in holes:
        here = moves & (at >= past) & (at < past + room)
        to, slot = F.when(here, F.lit(s)).otherwise(to), F.when(here, at - past + start).otherwise(slot)
        past += room
    out = rows_ranked.withColumn("surplus", surplus).withColumn("number", number + F.col("rank"))
    return out.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), to.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
