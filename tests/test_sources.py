import pytest
from pyspark.sql import functions as F

from cardloom.operators.profiles import agg_spec
from cardloom.sources import readers, staging
from cardloom.sources import tpch_cards as X


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_columns_go_by_name(spark, tmp_path):
    path = write(
        tmp_path / "cards.csv",
        "first_active_month,extra,target,card_id,feature_3,feature_2,feature_1\n"
        "2017-06,zz,-0.5,C_1,1,2,3\n2017-06-01,zz,,C_2,0,x,5\n",
    )
    got = readers.read_cards(spark, path).orderBy("card_id").collect()
    assert [(r.card_id, str(r.first_active_month)) for r in got] == [("C_1", "2017-06-01"), ("C_2", "2017-06-01")]
    assert [(r.feature_1, r.feature_2, r.feature_3, r.target) for r in got] == [(3, 2, 1, -0.5), (5, None, 0, None)]


def test_log_columns_go_by_name(spark, tmp_path):
    names = [
        "subsector_id", "state_id", "category_2", "purchase_date", "purchase_amount", "month_lag",
        "merchant_id", "merchant_category_id", "category_3", "installments", "category_1", "city_id",
        "card_id", "authorized_flag",
    ]
    row = "1,2,3.0,2017-06-25 15:33:07,-0.7,-8,M_1,80,A,0,N,88,C_1,Y"
    path = write(tmp_path / "log.csv", ",".join(names) + "\n" + row + "\n")
    r = readers.read_transactions(spark, path).first()
    assert (r.card_id, r.city_id, r.purchase_amount, str(r.purchase_date)) == ("C_1", 88, -0.7, "2017-06-25 15:33:07")


def test_a_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "cards.csv", "card_id,feature_1\nC_1,2\n")
    with pytest.raises(ValueError, match="first_active_month"):
        readers.read_cards(spark, path)


def test_distinct_counts_do_not_depend_on_the_column_name(spark):
    rows = spark.createDataFrame([("a", m) for m in (6, 70, 134, 134, -3)], "k string, month int")
    assert agg_spec(rows, "k", {"month": ("nunique",)}).first()["month_nunique"] == 4
    small = rows.where("month between 0 and 63")
    assert agg_spec(small, "k", {"month": ("small_nunique",)}).first()["month_nunique"] == 1


@pytest.fixture()
def made(spark, tmp_path):
    """Counts how often a stage is made from a table in files."""
    calls = []
    table = str(tmp_path / "table")
    spark.range(5).write.parquet(table)

    def run(path="stage", settings=None, table=table, plan=lambda df: df):
        rows = plan(spark.read.parquet(table))

        def make():
            calls.append(path)
            return staging.staged(rows.withColumn("x", F.col("id") * 2), "inner")

        return staging.resumed(
            spark, make, str(tmp_path / path), "double", settings or {"as_of": "2001"}, [rows]
        ).count()

    return run, calls, table, tmp_path


def test_a_stage_is_made_again_only_if_something_changed(spark, made):
    run, calls, table, tmp_path = made
    assert run() == 5 and len(calls) == 1
    assert run() == 5 and len(calls) == 1  # equal: read again
    assert run(settings={"as_of": "2002"}) == 5 and len(calls) == 2
    assert run(settings={"as_of": "2002"}) == 5 and len(calls) == 2
    spark.range(5, 8).write.mode("append").parquet(table)  # another file
    assert run(settings={"as_of": "2002"}) == 8 and len(calls) == 3
    assert run(settings={"as_of": "2002"}, plan=lambda df: df.where("id < 3")) == 3 and len(calls) == 4
    assert not list(tmp_path.glob("*.work"))  # spent inner stages are gone


def test_a_killed_run_goes_on(spark, made):
    run, calls, _, tmp_path = made
    run("a")
    with pytest.raises(RuntimeError):
        staging.resumed(spark, lambda: (_ for _ in ()).throw(RuntimeError()), str(tmp_path / "b"), "b")
    (tmp_path / "a" / "_SUCCESS").unlink()  # cut off while it was written
    assert run("a") == 5 and calls == ["a", "a"]
    (tmp_path / "a.manifest").write_text('{"name": "dou')  # cut off in its record
    assert run("a") == 5 and calls == ["a"] * 3
    assert run("a") == 5 and run("b") == 5 and calls == ["a", "a", "a", "b"]


def test_frames_without_files_are_told_by_their_rows(spark):
    one, two = (spark.createDataFrame([(i,)], "a int") for i in (1, 2))
    assert staging.fingerprint(one) != staging.fingerprint(two)
    again = spark.createDataFrame([(1,)], "a int")
    assert staging.fingerprint(one) == staging.fingerprint(again)
    assert staging.fingerprint(spark.range(3)) == staging.fingerprint(spark.range(3))


def test_stages_inside_operators_go_below_the_root(spark, tmp_path):
    with staging.stage_root(str(tmp_path / "work")):
        assert staging.staged(spark.range(3), "x").count() == 3
    assert list((tmp_path / "work").glob("cardloom/x-*"))
    staging.remove(spark, str(tmp_path / "work"))
    assert not (tmp_path / "work").exists()
    assert not staging.finished(spark, str(tmp_path / "work"))


def test_a_folder_of_differently_ordered_files(spark, tmp_path):
    folder = tmp_path / "cards"
    folder.mkdir()
    write(folder / "a.csv", "card_id,first_active_month,feature_1,feature_2,feature_3,target\nC_1,2017-06,1,2,3,0.5\n")
    write(folder / "b.csv", "first_active_month,card_id,target,feature_1,feature_2,feature_3\n2017-07,C_2,1.5,4,5,6\n")
    got = readers.read_cards(spark, str(folder), mixed=True).orderBy("card_id").collect()
    assert [(r.card_id, str(r.first_active_month), r.feature_3, r.target) for r in got] == [
        ("C_1", "2017-06-01", 3, 0.5),
        ("C_2", "2017-07-01", 6, 1.5),
    ]
    with pytest.raises(Exception, match="header"):
        readers.read_cards(spark, str(folder)).collect()
    write(folder / "c.csv", "first_active_month,card_id\n2017-07,C_3\n")
    with pytest.raises(ValueError, match="feature_1"):
        readers.read_cards(spark, str(folder), mixed=True)


def test_parquet_of_another_schema_is_refused(spark, tmp_path):
    path = str(tmp_path / "cards")
    row = spark.createDataFrame([("C_1", "2017-06", 1, 2, "x", 0.5)], "card_id string, first_active_month string, feature_1 int, feature_2 int, feature_3 string, target double")
    row.write.parquet(path)
    with pytest.raises(ValueError, match="feature_3 is string"):
        readers.read_cards(spark, path, "parquet")
    row.select("card_id").withColumnRenamed("card_id", "id").write.parquet(path + "2")
    with pytest.raises(ValueError, match="none of the columns"):
        readers.read_cards(spark, path + "2", "parquet")
    row.withColumn("feature_3", F.lit(7).cast("smallint")).write.parquet(path + "3")
    assert readers.read_cards(spark, path + "3", "parquet").first().feature_3 == 7


def test_lines_are_not_shuffled_to_meet_a_few_shops(spark, tmp_path):
    def table(name, *columns, n=10):
        spark.range(n).selectExpr(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))

    table("nation", "int(id) n_nationkey", "int(id % 5) n_regionkey", "string(id) n_name")
    # Shop 3 has no nation, shop 4 one that is not there, shop 5 is there twice, with nation 0 too.
    shop = "if(id = 10, 5, id) s_suppkey", "CASE id WHEN 3 THEN NULL WHEN 4 THEN 99 ELSE int(id % 10) END s_nationkey"
    table("supplier", *shop, n=11)
    table("part", "id p_partkey", "int(id) p_size", "string(id) p_brand")
    table("orders", "id o_orderkey", "id o_custkey", "'F' o_orderstatus", "'1-X' o_orderpriority",
          "timestamp_ntz'2001-05-03 00:00:00' o_orderdate")
    table("lineitem", "id % 10 l_orderkey", "id % 10 l_partkey", "nullif(id % 10, 9) l_suppkey", "1 l_linenumber",
          "1D l_quantity", "double(id) l_extendedprice", "'A' l_returnflag", "'F' l_linestatus", n=40)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        log = X.hist_log(spark, str(tmp_path))
        assert "hashpartitioning(l_suppkey" not in log._jdf.queryExecution().executedPlan().toString()
        got = {(r["city_id"], r["state_id"]): r["n"] for r in log.groupBy("city_id", "state_id").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {(c, c % 5): 8 if c == 0 else 4 for c in (0, 1, 2, 5, 6, 7, 8)}
