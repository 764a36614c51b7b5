import datetime as dt

import pytest
from pyspark.sql import functions as F

from shiftlake.functions import calendar as cal
from shiftlake.functions import codes, keys, text
from shiftlake.functions.records import has_keys, normalize_keys, parse_record


def one(spark, *columns, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(*columns).first()


@pytest.mark.parametrize("site, time, label, switch", [
    ("G1", "2020-08-22 07:29:59", "2020-08-21-N", "2020-08-22 07:30:00"),
    ("G1", "2020-08-22 07:30:00", "2020-08-22-D", "2020-08-22 19:30:00"),
    ("G1", "2020-08-22 19:29:59", "2020-08-22-D", "2020-08-22 19:30:00"),
    ("G1", "2020-08-22 19:30:00", "2020-08-22-N", "2020-08-23 07:30:00"),
    ("G1", "2020-08-22 23:00:00", "2020-08-22-N", "2020-08-23 07:30:00"),
    ("G1", "2020-08-22 00:45:00", "2020-08-21-N", "2020-08-22 07:30:00"),
    ("Z2", "2020-08-22 07:59:59", "2020-08-21-N", "2020-08-22 08:00:00"),
    ("Z2", "2020-08-22 08:00:00", "2020-08-22-D", "2020-08-22 20:00:00"),
    ("T1", "2020-08-22 19:59:59", "2020-08-22-D", "2020-08-22 20:00:00"),
    ("T1", "2020-08-22 20:00:00", "2020-08-22-N", "2020-08-23 08:00:00"),
    ("X1", "2020-08-22 20:00:00", None, None),
])
def test_shift(spark, site, time, label, switch):
    ts = F.to_timestamp("t")
    got = one(spark, cal.shift_label(ts, F.col("s")), text.format_second(cal.next_switch(ts, F.col("s"))), t=time, s=site)
    assert tuple(got) == (label, switch)


@pytest.mark.parametrize("day, week", [
    ("2020-01-01", "W01"), ("2020-01-05", "W01"), ("2020-01-06", "W02"), ("2020-01-12", "W02"), ("2020-01-13", "W03"),
    ("2020-12-31", "W01"), ("2021-01-04", "W02"), ("2022-01-02", "W01"),
])
def test_week(spark, day, week):
    assert one(spark, cal.week_label(F.col("d")), d=day)[0] == week


@pytest.mark.parametrize("value, valid", [
    ("Z2-DFH05", True), ("1Z2-DFH05", False), ("2000-BHFU03", False), (" Z2-HFU06", True), ("Z2-05", False),
    ("Z205", False), ("z2-df02a", True),
])
def test_equipment_id(spark, value, valid):
    assert one(spark, text.is_equipment_id(F.col("v")), v=value)[0] is valid


@pytest.mark.parametrize("value", ["2020-07-30 08:51:58", "2020/07/30 08:51:58", "20200730085158"])
def test_mixed_times(spark, value):
    assert one(spark, text.parse_mixed(F.col("v")), v=value)[0] == dt.datetime(2020, 7, 30, 8, 51, 58)


def test_times_that_do_not_exist(spark):
    got = one(spark, text.parse_mixed(F.lit("junk")), text.is_date_time(F.lit("2020-13-45 00:00:00")),
              text.is_date_time(F.lit(" 2020-01-05 00:00:00 ")), text.is_date_time(F.lit("2020-1-5 00:00:00")))
    assert tuple(got) == (None, False, True, False)


@pytest.mark.parametrize("value, expected", [("EqpID", "eqp_i_d"), ("OldStatus", "old_status"), ("_x", "x"), ("abc", "abc")])
def test_hump(spark, value, expected):
    assert one(spark, text.hump_to_underscore(F.col("v")), v=value)[0] == expected


def test_row_key(spark):
    import hashlib
    raw = "Z2-DF02|2020-07-29 14:09:23"
    prefix = hashlib.md5(raw.encode()).hexdigest()[:2]
    got = one(spark, keys.row_key(F.lit("Z2-DF02"), F.lit("2020-07-29 14:09:23")),
              keys.row_key(F.lit("Z2-DF02"), F.lit("2020-07-29 14:09:23"), suffix=keys.content_suffix(F.lit("a"))))
    assert got[0] == f"{prefix}|{raw}" and got[1].startswith(got[0] + "|") and len(got[1]) == len(got[0]) + 6


def test_factories_differ_on_purpose(spark):
    z1 = F.lit("Z1")
    assert tuple(one(spark, codes.factory_id(z1), codes.tester_factory(z1), codes.alarm_factory(z1))) == ("Other", "2", "2000")


@pytest.mark.parametrize("comment, expected", [("xcc by", "BY"), ("gsh", "GSH"), ("nothing", "NORMAL"), ("ccYP", "YP")])
def test_order_type(spark, comment, expected):
    assert one(spark, codes.order_type(F.col("c")), c=comment)[0] == expected


def normalized(spark, doc, **kw):
    df = spark.createDataFrame([(doc,)], ["v"]).select(parse_record(F.col("v")).alias("rec"))
    return normalize_keys(df, "rec", **kw).first()[0]


def test_normalize_collisions(spark):
    assert normalized(spark, '{"A":1,"a":2,"B":null,"b":3,"C":{"x":1}}') == {"a": "1", "b": "3", "c": '{"x":1}'}


def test_normalize_variants(spark):
    doc = '{"EqpID":"e","TubeText":"t","gone":null}'
    mapping = {"EqpID": "Id", "tubetext": "Text1"}
    assert normalized(spark, doc, mapping=mapping) == {"id": "e", "tubetext": "t", "gone": None}
    assert normalized(spark, doc, mapping=mapping, variant="lower_rename") == {"eqpid": "e", "Text1": "t", "gone": None}
    assert normalized(spark, doc, variant="lower", null_as_empty=True) == {"eqpid": "e", "tubetext": "t", "gone": ""}
    assert normalized(spark, doc, mapping=mapping, variant="rename_snake") == {"Id": "e", "tube_text": "t", "gone": None}


def test_null_value_counts_as_present(spark):
    df = spark.createDataFrame([('{"a":null,"b":"x"}',), ("broken",)], ["v"]).select(parse_record(F.col("v")).alias("rec"))
    assert [r[0] for r in df.select(has_keys(["a", "b"])).collect()] == [True, False]
