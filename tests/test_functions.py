from mallscope.functions.adlog import parse_ad_log, render_ad_log
from mallscope.functions.scalars import (epoch_ms_to_date, epoch_ms_to_minute, half_up_tenth,
                                         kv_key, minute_to_hhmm, ntz_epoch_ms, pairs_to_json, percent_tenth,
                                         split_ids, with_task_id)
from mallscope.sources.conditions import parse_conditions


def test_split_ids_drops_empty_entries(spark):
    df = spark.createDataFrame([("3",), ("3,5",), ("3,5,",), ("",), (",7,,8",)], "s string")
    got = [r[0] for r in df.select(split_ids("s")).collect()]
    assert got == [["3"], ["3", "5"], ["3", "5"], [], ["7", "8"]]


def test_half_up_rounding_matches_round_half_up(spark):
    # shares in percent, one decimal, halves upwards (towards +inf)
    df = spark.createDataFrame([(49, 400), (351, 400), (1, 3), (2, 3), (1, 8), (0, 5)], "n long, t long")
    got = [r[0] for r in df.select(percent_tenth("n", "t")).collect()]
    assert got == [12.3, 87.8, 33.3, 66.7, 12.5, 0.0]
    rest = spark.createDataFrame([(100.0 - 12.3 - 87.8,), (-0.05,), (0.05,)], "x double")
    assert [r[0] for r in rest.select(half_up_tenth("x")).collect()] == [-0.1, 0.0, 0.1]


def test_time_text_is_utc_and_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        df = spark.createDataFrame([(1704067207179,), (1704153599999,)], "ms long")
        got = df.select(epoch_ms_to_date("ms"), minute_to_hhmm(epoch_ms_to_minute("ms"))).collect()
        assert [tuple(r) for r in got] == [("2024-01-01", "00:00"), ("2024-01-01", "23:59")]
        ntz = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' ts")
        assert ntz.select(ntz_epoch_ms("ts")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_pairs_to_json_shape(spark):
    df = spark.createDataFrame([([("1", 16), ("6", 14)],)], "l array<struct<k:string,v:long>>")
    assert df.select(pairs_to_json("l", "k", "v")).first()[0] == '[{"1":16},{"6":14}]'


def test_kv_key_and_task_id(spark):
    df = spark.createDataFrame([("NORTH", "c1", "3")], "area string, city string, adid string")
    assert df.select(kv_key("area", "city", "adid")).first()[0] == "NORTH:c1:3"
    assert with_task_id(df, "t-1").columns[0] == "task_id"


def test_ad_line_round_trip_and_rejects(spark):
    ads = spark.createDataFrame([(1704067207179, "EUROPE", "FRANCE", "7", "3", 1)],
                                "timestamp long, area string, city string, userid string, adid string, event_id long")
    back = parse_ad_log(render_ad_log(ads, keep=["event_id"]), keep=["event_id"])
    assert back.collect() == ads.collect()
    bad = spark.createDataFrame([("1 A B",), ("x A B C D",), ("1  A B C D",), ("5 A B C D E",)], "line string")
    got = parse_ad_log(bad, with_rejects=True).select("ok").collect()
    # too few fields, non-numeric time, double space (empty field shifts positions), extra field
    assert [r[0] for r in got] == [False, False, True, True]
    assert parse_ad_log(bad).count() == 2


def test_conditions_lenient_json(spark):
    c = parse_conditions(spark, '{startDate:"2024-01-05", endDate:"2024-01-25", startAge: "20", '
                                'endAge: "50", professionals: "", targetPageFlow:"1,2,3"}')
    assert c["startDate"] == "2024-01-05" and c["startAge"] == "20" and c["professionals"] == ""
    assert c["city"] is None and c["targetPageFlow"] == "1,2,3"


def test_fixture_conditions_text_parses_to_the_fixture_conditions(spark):
    from mallscope.sources import fixtures as fx
    c = parse_conditions(spark, fx.CONDITIONS_TEXT)
    assert {k: c[k] for k in fx.CONDITIONS} == fx.CONDITIONS
    assert c["professionals"] == "" and c["categoryIds"] == ""


def test_load_table_by_catalog_name_and_conform(spark):
    import os
    import uuid

    import pytest

    from mallscope.session import checkpoint_root
    from mallscope.sinks.tables import replace_table
    from mallscope.sources.tables import CITY_INFO, conform, load_table
    name = "t_cities_" + uuid.uuid4().hex[:6]
    df = spark.createDataFrame([(1, "X", "A", "extra")], "city_id int, city_name string, area string, z string")
    replace_table(df, name, path=os.path.join(checkpoint_root(spark), name))
    got = load_table(spark, name, CITY_INFO)
    assert got.columns == ["city_id", "city_name", "area"]               # extra column dropped
    assert dict(got.dtypes)["city_id"] == "bigint" and got.first().city_id == 1
    with pytest.raises(ValueError):
        conform(df.drop("area"), CITY_INFO)                               # strict: missing column
    assert conform(df.drop("area"), CITY_INFO, strict=False).first().area is None
