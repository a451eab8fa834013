"""Co-located buckets against a plain version, file by file."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from datetime import date, datetime
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.llm import buckets, common, queries

SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, priority int"
LINES = "sale_id long, line_no int, item_id long, amount double, flag string, ok boolean, day date, raw binary, small short, tiny byte, part float"


def order(v):
    """Nulls first, NaN last, text by bytes."""
    if v is None:
        return (0,)
    if isinstance(v, float):
        return (2,) if math.isnan(v) else (1, v)
    return (1, v.encode() if isinstance(v, str) else bytes(v) if isinstance(v, bytearray) else v)


def row_order(row, first=0):
    return [order(row[first]), *[order(v) for k, v in enumerate(row) if k != first]]


def made(seed=1, n=120):
    rnd = random.Random(seed)
    maybe = lambda v: None if rnd.random() < 0.1 else v
    text = lambda: maybe(rnd.choice(["", "a", "a\0", "a\0b", "ab", "é", "￿", "😀", "done", "\0"]))
    number = lambda: maybe(rnd.choice([0.0, -1.5, 1e300, -1e-300, float("nan"), float("inf"), -float("inf"), 2.25]))
    ids = [rnd.choice([-7, 0, 3, *range(10, 60), 2**62]) for _ in range(n)]
    sales = [(maybe(i), maybe(rnd.randrange(-3, 3)), text(), number(), maybe(datetime(2024, 1, 1, rnd.randrange(24))), maybe(rnd.randrange(-2, 3))) for i in ids]
    lines = [(maybe(7 if rnd.random() < 0.3 else rnd.choice([-7, 0, 3, *range(10, 70), 2**62])), rnd.randrange(3), maybe(rnd.randrange(40)), number(), text(), maybe(rnd.random() < 0.5), maybe(date(2024, rnd.randrange(1, 12), 1)), maybe(rnd.choice([b"", b"\0", b"\0\xff", b"x"])), maybe(rnd.randrange(-300, 300)), maybe(rnd.randrange(-100, 100)), maybe(0.5)) for _ in range(4 * n)]
    return sales + [(7, 1, "hot", 1.0, None, 1)] * 40 + sales[:5], lines + lines[:9]


def crc(text):
    return zlib.crc32(text.encode())


def plain(first, second, starts, bucket, n):
    """{(table, bucket): (rows, lineage, joined, the start that stays)}."""
    known, count = {r[0] for r in first if r[0] is not None}, [Counter(r[0] for r in t if r[0] is not None) for t in (first, second)]
    out = {}
    for table, rows in enumerate((first, second)):
        begun, done = defaultdict(list), defaultdict(list)
        for r in rows:
            b = n + 1 if r[0] is None else n if table and r[0] not in known else bucket(r[0])
            s = starts[table](r)
            begun[s].append(r)
            done[b].append((s, r))
        for b, held in done.items():
            lineage = sorted(Counter(s for s, _ in held).items())
            joined = sum(count[0][i] * count[1][i] for i in count[0].keys() & count[1].keys() if bucket(i) == b) if b < n else 0
            stays = lineage[0][0] if len(lineage) == 1 and len(begun[lineage[0][0]]) == len(held) else None
            out[table, b] = sorted((r for _, r in held), key=row_order), lineage, joined, stays
    return out


def same(a, b):
    return order(a) == order(b) and (not isinstance(a, float) or math.isnan(a) or math.copysign(1, a) == math.copysign(1, b))


def compare(result, want, names, columns, folder):
    got = {(names.index(r["table_name"]), r["bucket"]): r for r in result.collect()}
    assert got.keys() == want.keys()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for at, (rows, lineage, joined, stays) in want.items():
        r = got[at]
        assert (r["n_rows"], r["n_joined"], r["rewritten"]) == (len(rows), joined, stays is None), at
        assert r["ids_sha256"] == digest(",".join("" if x[0] is None else str(x[0]) for x in rows))
        assert r["lineage_sha256"] == digest(",".join(f"{s}:{n}" for s, n in lineage))
        assert r["columns"] == ",".join(columns[at[0]])
        held = pq.read_table(r["path"].removeprefix("file:"))
        assert held.column_names == columns[at[0]]
        for x, y in zip(zip(*[c.to_pylist() for c in held.columns], strict=True), rows, strict=True):
            assert all(map(same, x, y)), (x, y)
    left = {str(p) for p in Path(folder).rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert left == {r["path"].removeprefix("file:") for r in got.values()}
    assert not list(Path(folder).rglob("_new*"))


CRC = "cast(pmod(crc32(concat('s', cast(sale_id AS string))), 8) AS int)"
ITEM = "coalesce(cast(pmod(crc32(cast(item_id AS string)), 8) AS int), 0)"
STARTS = {
    "apart": ((f"coalesce({CRC} - int({CRC} % 4 = 1), 9)", ITEM), (lambda r: 9 if r[0] is None else (b := crc(f"s{r[0]}") % 8) - (b % 4 == 1), lambda r: 0 if r[2] is None else crc(str(r[2])) % 8)),
    "one file": (("3", "5"), (lambda r: 3, lambda r: 5)),
    "in place": ((f"coalesce({CRC}, 9)", f"coalesce(7 - {CRC}, 30)"), (lambda r: 9 if r[0] is None else crc(f"s{r[0]}") % 8, lambda r: 30 if r[0] is None else 7 - crc(f"s{r[0]}") % 8)),
}


def bucketed(first, second, kind, folder, chunk=1 << 16):
    return buckets.co_bucketed(first, second, "sale_id", tuple(map(F.expr, STARTS[kind][0])), F.expr(CRC), 8, ("sales", "lines"), str(folder), chunk)


@pytest.mark.parametrize(("kind", "chunk"), [("apart", 7), ("apart", 1 << 16), ("one file", 50), ("in place", 16)])
def test_equals_plain_version(spark, tmp_path, kind, chunk):
    first, second = made()
    if kind == "in place":  # no partnerless rows but in two buckets, so other files of the second table stay too
        known = {r[0] for r in first}
        second = [r for r in second if r[0] in known or crc(f"s{r[0]}") % 8 < 2]
    own = STARTS[kind][1]
    a, b = (spark.createDataFrame(rows, T.StructType.fromDDL(k)).repartition(4) for rows, k in ((first, SALES), (second, LINES)))
    got = bucketed(a, b, kind, tmp_path / "pair", chunk)
    want = plain(first, second, own, lambda i: crc(f"s{i}") % 8, 8)
    assert any(w[3] is not None for w in want.values()) == (kind != "one file")
    compare(got, want, ["sales", "lines"], [a.columns, b.columns], tmp_path / "pair")


def test_empty_and_refused(spark, tmp_path):
    first, second = made(2, 30)
    none = spark.createDataFrame([], T.StructType.fromDDL(SALES))
    lines = spark.createDataFrame(second, T.StructType.fromDDL(LINES))
    own = STARTS["apart"][1]
    compare(bucketed(none, lines, "apart", tmp_path / "x"), plain([], second, own, None, 8), ["sales", "lines"], [none.columns, lines.columns], tmp_path / "x")
    assert bucketed(none, lines.limit(0), "apart", tmp_path / "y").count() == 0
    with pytest.raises(ValueError, match="can't be sorted"):
        bucketed(none.withColumn("l", F.array(F.lit(1))), lines, "apart", tmp_path / "z")


def test_rows_as_bytes():
    """Back unchanged, and ordered as the rows are, whatever column is the key; names may clash."""
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(["tag", "number", "data", "at", "a`b", "c0", "k", "__starting_file", "x", "y", "z"], T.StructType.fromDDL(LINES).fields, strict=True)])
    rows = made(5)[1]
    for key in ("tag", "a`b"):
        keys = buckets.RowKeys(schema, key)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), keys.arrow, strict=True)], schema=keys.arrow)
        data, at = keys.encode(batch, np.zeros(len(rows), np.int64), np.arange(len(rows)))
        coded = sorted(data[a:b] for a, b in zip(at, at[1:]))
        back, tags = keys.decode(coded)
        place = schema.names.index(key)
        want = sorted(range(len(rows)), key=lambda k: (row_order(rows[k], place), k))
        assert [row_order(r, place) for r in zip(*[c.to_pylist() for c in back.columns], strict=True)] == [row_order(rows[k], place) for k in want]
        assert sorted(tags.tolist()) == list(range(len(rows)))


def test_partner_across_chunks(tmp_path):
    rnd = random.Random(3)
    held = sorted(rnd.choice([*range(0, 400, 3), 33, 33, 33]) for _ in range(500))
    pq.write_table(pa.table({"k": pa.array([None, *held], pa.int64())}), tmp_path / "f.parquet")
    asked = np.array(sorted(rnd.choice(range(-5, 420)) for _ in range(300)) + [500, 500])
    for chunk in (1, 7, 10**6):
        partner = buckets.Partner(str(tmp_path / "f.parquet"), "k", chunk)
        got = np.concatenate([partner.rows_with(asked[k : k + 13]) for k in range(0, len(asked), 13)])
        assert got.tolist() == [held.count(k) for k in asked.tolist()]
    assert buckets.Partner(None, "k").rows_with(asked).sum() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    tables = [[tuple(r) for r in common.table(spark, sf, t).collect()] for t in ("sales", "sale_lines")]
    columns = [common.table(spark, sf, t).columns for t in ("sales", "sale_lines")]
    own = (lambda r: 601 if r[0] is None else (b := crc(f"s{r[0]}") % 600) - (b % 4 == 1), lambda r: 0 if r[2] is None else crc(str(r[2])) % 600)
    got = queries.op13_co_bucketed(spark, sf)
    folder = Path(got.first()["path"].removeprefix("file:")).parent.parent
    compare(got, plain(*tables, own, lambda i: crc(f"s{i}") % 600, 600), ["sales", "sale_lines"], columns, folder)


def test_registered():
    assert "op13_co_bucketed" in queries.queries() and "op13_co_bucketed" not in queries.oracle_sql()
