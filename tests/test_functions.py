from pyspark.sql import functions as F

from tumbleweed.functions.fields import is_plain_path, nested_path_sql
from tumbleweed.functions.intervals import parse_interval_ms
from tumbleweed.functions.scalars import local_day_num, row_key, timestamped_value


def test_intervals():
    assert parse_interval_ms("10m") == 600_000
    assert parse_interval_ms("3h") == 10_800_000
    assert parse_interval_ms("1min") == 60_000
    assert parse_interval_ms("7d") == 7 * 86_400_000
    assert parse_interval_ms("1s") == 1_000
    for bad in ("10x", "0m", "", None, "m", "1.5h"):
        assert parse_interval_ms(bad) is None


def test_plain_paths():
    assert is_plain_path("uid") and is_plain_path("ext.pay") and is_plain_path("eventType")
    assert not is_plain_path("ext.a.b") and not is_plain_path("ext.k * 10") and not is_plain_path(None)
    assert nested_path_sql("ext.o.a") == "get_json_object(try_element_at(ext, 'o'), '$.a')"
    assert nested_path_sql("pay.amount") == "get_json_object(try_element_at(attrs, 'pay'), '$.amount')"
    assert nested_path_sql("ext.a") is None and nested_path_sql("upper(x)") is None


def test_row_key_and_cache_text(spark):
    row = spark.range(1).select(row_key(F.lit("12345")).alias("k"),
                                timestamped_value(F.lit(7).cast("bigint"), F.lit("v")).alias("t")).first()
    assert row.k == "512345" and row.t == "ts:7,v"


def test_day_floor_utc_plus_8(spark):
    """F-4: the local day at UTC+8, checked at 03:00 and 12:00 local time."""
    day = 86_400_000
    # 2024-01-02 03:00 +08:00 = 2024-01-01 19:00 UTC; 12:00 +08:00 = 04:00 UTC
    t0300 = 19_723 * day - 5 * 3_600_000
    t1200 = 19_723 * day + 4 * 3_600_000
    r = spark.range(1).select(local_day_num(F.lit(t0300), "Asia/Shanghai").alias("a"),
                              local_day_num(F.lit(t1200), "Asia/Shanghai").alias("b"),
                              local_day_num(F.lit(t0300)).alias("utc")).first()
    assert r.a == 19_723 and r.b == 19_723 and r.utc == 19_722
