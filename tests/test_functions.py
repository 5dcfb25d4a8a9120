"""Null order, null-aware exclusion, rounding, epoch text and nested lists."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import dialect, variants
from larder.functions.versions import latest_version, not_in


def values(spark, expression, rows="VALUES (1) t(x)"):
    return [r[0] for r in spark.sql(f"SELECT {expression} FROM {rows}").collect()]


def test_latest_version_ranks_a_missing_update_time_first(spark):
    rows = spark.createDataFrame(
        [("a", 1, None, "old"), ("a", None, None, "newest"), ("b", 1, 1, "b1"), ("b", 1, 2, "b2"), ("b", 1, None, "b3")],
        "_ID string, UPDATEDATETIME int, __TS_MS int, v string",
    )
    assert {r.v for r in latest_version(rows, "_ID").collect()} == {"newest", "b3"}


def test_a_hot_key_is_limited_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) AS _ID", "id AS UPDATEDATETIME", "id AS __TS_MS")
    plan = latest_version(rows, "_ID")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(
    "listed, kept",
    [(["a"], {"b"}), ([], {"a", "b", None}), (["a", None], set()), (["z"], {"a", "b"})],
)
def test_not_in_follows_sql(spark, listed, kept):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ids = spark.createDataFrame([(i,) for i in listed], "demo_id string")
    assert {r.k for r in not_in(rows, "k", ids).collect()} == kept
    rows.createOrReplaceTempView("rows")
    ids.createOrReplaceTempView("ids")
    assert {r.k for r in spark.sql("SELECT k FROM rows WHERE k NOT IN (SELECT demo_id FROM ids)").collect()} == kept


def test_integers_round_halves_away_from_zero(spark):
    get = variants.path_as("try_parse_json(j)", "$.v", dialect.NUM38)
    rows = """VALUES ('{"v": 2.5}'), ('{"v": "2.7"}'), ('{"v": -2.5}'), ('{"v": null}'), ('{}') t(j)"""
    assert [None if v is None else int(v) for v in values(spark, get, rows)] == [3, 3, -3, None, None]


def test_a_bad_amount_is_an_error_but_bad_json_is_not(spark):
    get = variants.path_as("try_parse_json(j)", "$.v", dialect.NUM38)
    assert values(spark, get, "VALUES ('oops') t(j)") == [None]
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID"):
        values(spark, get, """VALUES ('{"v": "many"}') t(j)""")


def test_epoch_text_guard(spark):
    rows = "VALUES ('1000000000123'), ('pending'), ('-5'), ('1.5'), (NULL) t(x)"
    assert values(spark, dialect.ntz_from_epoch_text("x"), rows) == [
        dt.datetime(2001, 9, 9, 1, 46, 40, 123000), None, None, None, None]


def test_zone_conversion_and_unknown_zone(spark):
    ts = "timestamp_ntz'2000-07-01 20:00:00'"
    assert values(spark, dialect.to_zone("'Asia/Tokyo'", ts)) == [dt.datetime(2000, 7, 2, 5)]
    assert values(spark, dialect.to_zone("CAST(NULL AS STRING)", ts)) == [None]


def test_second_boundaries_count_boundaries(spark):
    assert values(spark, dialect.second_boundaries("900", "1100")) == [1]
    assert values(spark, dialect.second_boundaries("1100", "1900")) == [0]


def test_lists_as_arrays_and_as_objects(spark):
    rows = """VALUES ('[1, 2]'), ('{"_0": 1, "_1": 2}'), ('{}'), ('[]'), ('oops'), (NULL), ('7') t(j)"""
    got = values(spark, f"transform({variants.elements('try_parse_json(j)')}, v -> CAST(v AS INT))", rows)
    assert got == [[1, 2], [1, 2], [], [], None, None, None]


def test_member_count(spark):
    rows = """VALUES ('{"a": 1, "b": 2}'), ('{}'), ('[1]'), (NULL) t(j)"""
    assert values(spark, variants.member_count("j"), rows) == [2, 0, None, None]


def test_dates_move_by_rounded_days(spark):
    row = spark.sql("SELECT date'2000-01-01' d, 2.5D n").select(dialect.add_days(F.col("d"), F.col("n"))).first()
    assert row[0] == dt.date(2000, 1, 4)


def test_the_buyer_log_is_read_once(spark):
    from larder.operators import accounts

    rows = [("B1", False, False, 1, 0, "x", '{"CreateTime": "900"}'), ("B1", False, False, 3, 0, "new", '{"CreateTime": "1000"}'),
            ("B1", False, False, 2, 0, "old", '{"CreateTime": "2000"}'), ("B2", False, False, 5, 0, "first", None),
            ("B2", False, False, None, 0, "newest", "{}"), ("B2", False, True, 9, 0, "deleted", None),
            (None, False, False, 1, 1, "a", None), (None, False, False, 1, 2, "b", '{"CreateTime": "5"}')]
    log = spark.createDataFrame(rows, "_ID string, ISDEMOACCOUNT boolean, ISDELETED boolean, UPDATEDATETIME int, "
                                      "__TS_MS int, NAME string, RECORD_METADATA string")
    live = accounts._live_buyers(log, spark.createDataFrame([], "demo_id string"), ["NAME"])
    got = {(r._ID, r.NAME, None if r.buyer_created_at is None else r.buyer_created_at.timestamp() * 1000) for r in live.collect()}
    zero = dt.datetime(1970, 1, 1).timestamp() * 1000
    # Text order: "1000" comes before "900".
    assert got == {("B1", "new", zero + 1000), ("B2", "newest", None), (None, "b", zero + 5)}
    plan = live._jdf.queryExecution().optimizedPlan().toString()
    assert sum("NAME#" in line and ("LogicalRDD" in line or "LocalRelation" in line) for line in plan.splitlines()) == 1
