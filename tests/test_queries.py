"""Every screening query with SQL against DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from cadastra import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query(spark, duck, name):
    compare(duck, Q.queries()[name](spark, SF), Q.oracle_sql()[name])


def compare(duck, got, sql):
    cols = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
    rows = [tuple(r) for r in got.select(*cols).collect()]
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(rows, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name", ["fixture_run", "fixture_scored"])
def test_check(spark, duck, name):
    """Runs on the synthetic county."""
    from cadastra.source_queries import CHECKS

    run, sql = CHECKS[name]
    assert name not in Q.queries()
    compare(duck, run(spark, SF), sql)


@pytest.mark.parametrize("name", ["cli_run", "usable_totals", "stage2_encumbrances"])
def test_parcels_beyond_ten_thousand_kilometres(spark, duck, tmp_path, name):
    """Study areas reach as far as the parcels: keys of a table sixty times as large."""
    duck.sql(f"COPY (SELECT * REPLACE (c_custkey + 600000 AS c_custkey) FROM customer WHERE c_custkey < 30) TO '{tmp_path}/customer.parquet'")
    with duckdb.connect() as far:
        far.sql(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
        for t in ("orders", "nation"):
            far.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        compare(far, Q.queries()[name](spark, str(tmp_path)), Q.oracle_sql()[name])


def test_no_cartesian_products(spark):
    for name in ("encumbrance_rows", "zoning_argmax", "row_distance_join", "owner_match_pairs", "stage1_accounts", "stage2_encumbrances", "stage3_usable", "stage4_access"):
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan, name


def test_parts_are_united_once_in_tasks_of_cells(spark):
    """Not for each of two results, and not in the few tasks of the orders' row groups."""
    plan = Q.QUERIES["union_area_by_implication"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "partial_geo_union(" in line][-1]
    assert first.count("partial_geo_union(") == 1 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_pieces_of_the_boundary_are_stored_once(spark, tmp_path, monkeypatch):
    """Stage 4 keeps a parcel's pieces in its row: some 1.5 KB a parcel on disk, where three tables of pieces took 11."""
    from cadastra.plans import access

    stored = []
    cut = access.cut
    monkeypatch.setattr(access, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    n = Q.queries()["frontage_pieces"](spark, SF).select("k").distinct().count()
    paths = [Path(f.removeprefix("file://")) for df in stored for f in df.inputFiles()]
    assert 0 < sum(p.stat().st_size for p in paths) < 5000 * n


def test_entry_runs_need_no_windows(spark, duck, tmp_path):
    """An aggregate of pieces dealt by their number, not windows over all; with numbers that come twice, have gaps or are missing."""
    duck.sql(f"COPY (SELECT * REPLACE (l_orderkey // 5 AS l_orderkey, CASE WHEN l_partkey % 7 <> 0 THEN l_linenumber + l_partkey % 3 END AS l_linenumber) FROM lineitem) TO '{tmp_path}/lineitem.parquet'")
    with duckdb.connect() as odd:
        odd.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
        got = Q.queries()["entry_runs"](spark, str(tmp_path))
        compare(odd, got, Q.oracle_sql()["entry_runs"])
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_stage4_broadcasts_nothing_and_deals_its_work(spark, monkeypatch):
    """No side of a join stands in the driver, and the roads, few bytes but much work, are cut into pieces by many tasks."""
    from cadastra.plans import access

    plans, parts = [], []
    cut = access.cut
    monkeypatch.setattr(access, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or parts.append(cut(df)) or parts[-1])
    for name in ("stage4_access", "reserve_strips", "frontage_pieces", "access_totals"):
        plans.append(Q.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert "SortMergeJoin" in "".join(plans) and "Broadcast" not in "".join(plans)
    assert "REPARTITION_BY_NUM" in plans[0] and "REPARTITION_BY_NUM" in plans[2]


def test_shapes_of_roads_are_made_once_for_each_road(spark):
    """Their tests aren't pushed below the aggregate that finds the roads, where they would run for each customer."""
    from cadastra.cadastre import roads
    from cadastra.kernel import functions as K

    plan = roads(spark, SF).where(K.intersects("geom", "geom"))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("geo_between") < plan.index("Aggregate [")
