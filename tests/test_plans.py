"""Plans the library relies on."""

from pyspark.sql import functions as F

from fleetlake.functions.scalar import dsum
from fleetlake.operators import filters, joins, sets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_one_row_per_key_before_the_shuffle(tables):
    text = plan(sets.dedup_latest(tables["orders"], ["o_custkey"], ["-o_totalprice", "o_orderkey"]))
    assert text.count("WindowGroupLimit") == 2  # partial and final


def test_filters_and_columns_reach_the_scan(tables):
    df = filters.period_slice(tables["orders"], "o_orderdate", "1999-01-01", "1999-12-31").select("o_orderkey")
    text = plan(df)
    assert "LessThanOrEqual(o" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp>" in text


def test_year_filter_is_a_range(tables):
    text = plan(filters.dim_filter(tables["orders"], {"year": 1998}, "o_orderdate"))
    assert "LessThanOrEqual(o" in text and "year(" not in text


def test_anti_join(tables):
    text = plan(tables["orders"].join(tables["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"))
    assert "LeftAnti" in text


def test_range_joins_carry_equality_keys(tables):
    facts = tables["orders"].select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    line = facts.groupBy("o_orderpriority", F.col("d").alias("since")).agg(F.max("o_orderkey").alias("price"))
    text = plan(joins.asof_join(facts, line, ["o_orderpriority"], "d", "since", "price"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_top_k_does_not_sort_everything(tables):
    assert "TakeOrderedAndProject" in plan(tables["orders"].orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5))


def test_exact_sums_stay_in_generated_code(spark, tables):
    g = tables["orders"].groupBy("o_orderstatus").agg(dsum("o_totalprice").alias("s"))
    assert "*(1) HashAggregate" in plan(g) or "HashAggregate" in plan(g)
    assert "SortAggregate" not in plan(g) and "ObjectHashAggregate" not in plan(g)


def test_scratch_is_removed(spark, monkeypatch):
    from fleetlake import session

    monkeypatch.setattr(session, "scratch_root", lambda s: f"{session.shared_dir(s)}/fleetlake/a-job")
    kept = session.materialise(spark.range(3).toDF("x"), "kept")
    path = spark._jvm.org.apache.hadoop.fs.Path(session.scratch_root(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert kept.count() == 3 and files.exists(path)
    assert session.remove_scratch(spark) and not files.exists(path)
    assert not session.remove_scratch(spark)
