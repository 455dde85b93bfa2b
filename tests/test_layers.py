"""Views, loads under the contract, and refresh of one period, on small fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradecast.operators import profile as PR
from tradecast.registry import cleaned
from tradecast.sources import io as IO
from tradecast.sources import load as LD
from tradecast.sources import views as V
from tradecast.sources.roles import Roles

DAY = dt.date(2000, 1, 1)
PRODUCTS = [(1, "Rose", "LARGE", "red"), (2, "Lily", "HUGE", "white"), (3, "Rose", "SMALL", "pink"), (4, None, "SMALL", "x"), (5, "Iris", "SMALL", "blue")]
SITES = [(1, "A", Decimal("2.50"), 1, 0), (2, "B", Decimal("-1.00"), 1, 0), (3, "C", Decimal("1.00"), 2, 0), (4, "D" * 21, Decimal("1.00"), 5, 0),
         (1, "E", Decimal("1.00"), 5, 0), (6, "F", Decimal("3.00"), 5, None)]


def _load(spark, tmp_path, products=PRODUCTS, sites=SITES):
    frames = {"product": spark.createDataFrame(products, IO.RAW_SCHEMAS["product"].simpleString()),
              "site": spark.createDataFrame(sites, IO.RAW_SCHEMAS["site"].simpleString())}
    base = str(tmp_path / "load")
    return base, [tuple(r) for r in LD.load_all(spark, frames, base).collect()]


def test_each_defect_is_quarantined_once(spark, tmp_path):
    base, counts = _load(spark, tmp_path)
    assert counts == [(1, "product", 2, 3), (2, "site", 2, 4)]
    bad = {r["product_id"]: r["broken"] for r in LD.quarantined(spark, f"{base}/product").collect()}
    # of two products of one name the smaller id, the first in the order of columns, stays
    assert bad == {2: ["domain:kind"], 3: ["unique:name"], 4: ["not_null:name"]}
    sites = sorted((r["site_id"], r["code"][:1], r["broken"]) for r in LD.quarantined(spark, f"{base}/site").collect())
    assert sites == [(1, "E", ["unique:site_id"]), (2, "B", ["positive:area"]), (3, "C", ["foreign_key:product_id"]), (4, "D", ["width:code"])]
    assert sorted(r["site_id"] for r in LD.accepted(spark, f"{base}/site").collect()) == [1, 6]


def test_an_append_refuses_keys_that_are_loaded(spark, tmp_path):
    base, _ = _load(spark, tmp_path)
    more = spark.createDataFrame([(1, "New", "LARGE", "a"), (9, "Iris", "LARGE", "a"), (10, "Fern", "LARGE", "a")], IO.RAW_SCHEMAS["product"].simpleString())
    got = LD.load_entity(more, LD.SPECS["product"], f"{base}/product", {}, append=True)
    assert got == {"n_loaded": 1, "n_quarantined": 2}
    assert sorted(r["product_id"] for r in LD.accepted(spark, f"{base}/product").collect()) == [1, 5, 10]


def test_one_scan_writes_and_counts(spark):
    rows = spark.createDataFrame(PRODUCTS, IO.RAW_SCHEMAS["product"].simpleString())
    plan = LD.checked(rows, LD.SPECS["product"], {})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_malformed_lines_keep_their_text(spark, tmp_path):
    path = tmp_path / "p"
    path.mkdir()
    (path / "a.csv").write_text("product_id,name,kind,color\n1,Rose,LARGE,red\nx,Lily,SMALL,white\n3,only two\n4,Iris,SMALL,blue\n")
    out = {r["_corrupt_record"]: r["name"] for r in LD.read_csv_permissive(spark, str(path), "product").collect()}
    assert set(out) == {None, "x,Lily,SMALL,white", "3,only two"}
    with pytest.raises(Exception, match="(?i)malformed"):
        IO.read_csv(spark, str(path), "product").collect()


def test_a_late_year_leaves_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.range(100).select("id", (F.lit(1990) + F.col("id") % 5).cast("int").alias("year"))
    IO.write_mart(df, path, ["year"])

    def files():
        rows = spark.read.parquet(path).select("year", F.input_file_name().alias("f")).distinct().collect()
        return {y: {r["f"] for r in rows if r["year"] == y} for y in {r["year"] for r in rows}}
    before = files()
    IO.refresh_partitions(df.where("year = 1992").withColumn("id", F.col("id") + 1000), path, ["year"])
    after = files()
    assert {y for y in before if before[y] != after[y]} == {1992}
    assert not before[1992] & after[1992]
    assert spark.read.parquet(path).where("year = 1992").agg(F.min("id"), F.count("*")).first() == (1002, 20)
    assert spark.read.parquet(path).count() == 100


def test_views_are_created_after_what_they_read():
    order = V.creation_order(V.CATALOG)
    assert len(order) == len(V.CATALOG) == 16
    assert all(order.index(r) < order.index(n) for n in order for r in V.CATALOG[n].reads)
    assert V.creation_order(V.CATALOG, ["sales"]) == ["customer_map", "sales"]


def test_views_answer_as_their_frames_and_go(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    for _ in range(2):  # a re-run replaces them
        V.create_views(spark, c.roles, "a_")
    V.create_views(spark, c.roles, "b_", ["product"])
    from tradecast.plans import marts as G
    for name, want in (("sales", c.sales), ("customer", c.customer), ("site_yield", G.g3_site_yield(c)), ("sales_monthly", G.g1_sales_monthly(c))):
        got = spark.table(f"a_{name}")
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    gone = V.drop_views(spark, "a_")
    assert len(gone) == 16 and gone.index("a_sales_monthly") < gone.index("a_sales") < gone.index("a_customer_map")
    assert not spark.catalog.tableExists("a_sales") and spark.catalog.tableExists("b_product")
    assert V.drop_views(spark, "b_") == ["b_product"]


def test_bucketed_facts_join_without_an_exchange(spark, sf_dir):
    plain, dealt = Roles(spark, sf_dir), Roles(spark, sf_dir, buckets=8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("sale_raw", "production"):
            got, want = getattr(dealt, name), getattr(plain, name)
            plan = [x._jdf.queryExecution().executedPlan().toString() for x in (got, want)]
            assert "Exchange" not in plan[0] and "SortMergeJoin" in plan[0], plan[0]
            assert "Exchange" in plan[1]
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        # columns are pruned at the bucketed scan too
        assert "l_comment" not in dealt.sale_raw._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sketches_of_periods_merge_to_the_profile(spark, tmp_path):
    rows = spark.range(60_000).select(
        "id", F.when(F.col("id") % 7 > 0, F.col("id") % 9973).alias("few"), F.lit(None).cast("date").alias("never"),
        (1990 + F.col("id") % 4).cast("int").alias("year"))
    path = str(tmp_path / "sketches")
    IO.write_mart(PR.profile_sketches(rows, "year"), path, ["period"])
    exact = {r["column_name"]: r for r in PR.column_profile(rows).collect()}

    def merged():
        return {r["column_name"]: r for r in PR.merged_profile(spark.read.parquet(path)).collect()}
    got = merged()
    assert set(got) == set(exact)
    for c, r in got.items():
        assert (r["data_type"], r["null_count"], r["null_pct"]) == (exact[c]["data_type"], exact[c]["null_count"], exact[c]["null_pct"])
        assert abs(r["distinct_count"] - exact[c]["distinct_count"]) <= PR.distinct_error() * exact[c]["distinct_count"]
    # a late year replaces its own sketches: the merged profile is that of the new rows
    late = rows.where("year = 1991").withColumn("id", F.col("id") + 1_000_000).limit(100)
    IO.refresh_partitions(PR.profile_sketches(late, "year"), path, ["period"])
    assert abs(merged()["id"]["distinct_count"] - 45_100) <= PR.distinct_error() * 45_100
    assert PR.profile_error(PR.merged_profile(spark.read.parquet(path)), PR.column_profile(rows.where("year != 1991").unionByName(late))).where(
        "NOT within_error").count() == 0


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, year int")
    assert PR.profile_sketches(empty, "year").count() == PR.merged_profile(PR.profile_sketches(empty, "year")).count() == 0
