"""Jobs on hand-written lines."""

import json

import pytest
from pyspark.sql import functions as F

from shiftlake.functions.keys import content_suffix
from shiftlake.functions.records import field
from shiftlake.operators import changes, wide
from shiftlake.plans import jobs


def feed(spark, *docs, **kept):
    rows = [(d if isinstance(d, str) else json.dumps(d), i) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "value string, seq bigint")


def test_loader_keeps_given_entries(spark):
    line = {"EqpID": "Z2-DF02", "TubeID": "Tube2", "Tube2Text1": "x", "PutTime": "2020-07-29 07:09:23", "Shift": "mine",
            "Site": None}
    rows = jobs.load_records(feed(spark, line), {"Tube2Text1": "text1"}, created=F.lit("now"),
                             suffix=content_suffix(F.lit("a"))).collect()
    rec = rows[0].rec
    assert rec["shift"] == "mine" and rec["site"] == "Z2" and rec["factory"] == "4" and rec["text1"] == "x"
    assert rec["day_date"] == "2020-07-28" and rec["long_time"] == "1595977763" and rec["create_time"] == "now"
    assert rec["row_key"].split("|")[1:4] == ["Z2-DF02", "2020-07-29 07:09:23", "Tube2"]


def test_rejected_lines_have_a_reason(spark):
    out = jobs.rejected(feed(spark, "{broken", {"EqpID": "bad", "PutTime": "x"}, {"EqpID": "Z2-DF02"},
                             {"EqpID": "Z2-DF02", "PutTime": "2020-13-45 00:00:00"},
                             {"EqpID": "Z2-DF02", "PutTime": "2020-01-05 00:00:00"}))
    assert [(r.seq, r.reason) for r in out.orderBy("seq").collect()] == [
        (0, "malformed"), (1, "bad_id"), (2, "blank_time"), (3, "bad_time")]


def test_alarm_tube(spark):
    base = {"PutTime": "2020-07-30 07:29:11", "Status": "S1", "TubeID1": "S0", "TubeID3": "S1", "TubeID5": "S1"}
    out = jobs.load_alarms(feed(spark, {**base, "EqpID": "Z2-DF01"}, {**base, "EqpID": "Z2-TA01"},
                                {**base, "EqpID": "Z2-PE01", "Status": "S7"}))
    found = [(r.rec["tubeid"], "tubeid3" in r.rec, r.rec["row_key"].count("|")) for r in out.orderBy("seq").collect()]
    assert found == [("TubeID3", False, 3), ("", False, 2), ("", False, 2)]


def test_alarm_actions(spark):
    base = {"PutTime": "2020/07/30 07:29:11", "Status": "1", "AlarmCode": "7"}
    out = jobs.alarm_actions(feed(
        spark, {**base, "EqpID": "T1-DF01", "AlarmText": None}, {**base, "EqpID": "G1-DF01", "AlarmText": "x Cleared"},
        {**base, "EqpID": "X1-DF01", "AlarmText": "door"}, {"EqpID": "Z1-DF01"}))
    assert sorted((r.machineid, r.alarmtext, r.factory) for r in out.collect()) == [
        ("T1-DF01", "", "3000"), ("X1-DF01", "door", "Other")]


def test_status_outputs(spark):
    base = {"EqpID": "Z2-DF01", "OldStatus": "a", "OldTime": "2020-07-30 08:00:00"}
    lines = [{**base, "NewStatus": "b", "NewTime": "20200730085158"}, {**base, "NewStatus": "c", "NewTime": "2020/07/30 08:51:59"},
             {**base, "NewStatus": "d", "NewTime": "junk"}, {**base, "NewStatus": "e"}]
    out = jobs.status_outputs(feed(spark, *lines))
    assert sorted(r.newstatusname for r in out["history"].collect()) == ["b", "c"]
    assert [(r.name, r.statuscodename) for r in out["update"].collect()] == [("Z2-DF01", "c")]


def material(eqp, come, *values):
    return {"EquipmentID": eqp, "Data": {"MtlEvtData": {"MtlEvt": {"@Name": "n", "MtlList": {"Mtl": {
        "@EqMtlId": "m", "@Come": come, "MeasValsList": {"MeasVals": {"@ToolId": "t", "MeasVal": [
            {"@Id": i, "#text": v} for i, v in values]}}}}}}}}


def test_measurements(spark):
    state = {"EquipmentID": "e2", "Data": {"EqState": {"Eq": {"@EqId": "q", "States": {"State": {"@Id": "s", "@Come": "c"}}}}}}
    out = jobs.measurement_outputs(feed(
        spark, material("e1", "c1", ("A", " x\\n "), ("Come", "other"), ("A", "last")), material("e1", " "), state,
        {"EquipmentID": "e", "Data": {}}))
    rows = out["material"].collect()
    assert len(rows) == 1 and rows[0].cells["A"] == "last" and rows[0].cells["Come"] == "other" and rows[0].cells["ToolId"] == "t"
    assert [r.cells for r in out["state"].collect()] == [{"EquipmentID": "e2", "EqId": "q", "StateId": "s", "Come": "c"}]


@pytest.mark.parametrize("material_id, parts", [
    ("WAFRDF02-1B0001CZ2#00012", ("DF02-1", "B0001", "C", "Z200012")),
    ("WAFRDF02-1B0001CDZ2#00012", ("DF02-1", "B0001", "CD", "Z200012")),
    ("WAFRDF02-1B0001CZ2#0001", None),
    ("DF-1B0001CZ2#00012345678", None),
])
def test_defect_material(spark, material_id, parts):
    line = {"EquipmentID": "GP-1", "EqMtlId": material_id + " rest", "Cls_CellQ": "FaHong", "Cls_ColQ": "ok",
            "Come": "2020-01-01 00:00:00"}
    rows = jobs.defect_feed(feed(spark, line, {**line, "Cls_CellQ": "ok"}, {**line, "Come": ""})).collect()
    assert [(r.tube_id, r.boat_id, r.area, r.site) for r in rows] == ([parts] if parts else [])


def test_silence_alarms(spark):
    def beat(eqp, time):
        return {"data": {"eqp_id": eqp, "TestDate": "01-02-2020", "TestTime": time}}

    devices = spark.createDataFrame([("Z2-H1",), ("Z2-H2",)], "eqp_id string")
    out = jobs.tester_silence(feed(spark, beat("Z2-H1", "00:10:00"), beat("Z2-H1", "00:20:00"), beat("T1-H9", "02:10:00"),
                                   beat("", "01:00:00")), devices, 3600)
    got = {(r.eqp_id, r.begin_time[11:13]): (r.status, r.cnt, r.msg) for r in out.collect()}
    silent = {k: v for k, v in got.items() if v[0] == 0}
    assert got[("Z2-H1", "00")] == (1, 2, None) and got[("T1-H9", "02")] == (1, 1, None) and ("T1-H9", "00") not in got
    assert set(silent) == {("Z2-H1", "01"), ("Z2-H1", "02"), ("Z2-H2", "00"), ("Z2-H2", "01"), ("Z2-H2", "02")}
    assert silent[("Z2-H2", "00")][2] == "No message received for a long time(Z2-H2)"


def test_silence_covers_the_whole_span_of_right_clocks(spark):
    def beat(eqp, day, time):
        return {"data": {"eqp_id": eqp, "TestDate": day, "TestTime": time}}

    devices = spark.createDataFrame([("Z2-H1",), ("Z2-H2",)], "eqp_id string")
    lines = feed(spark, beat("Z2-H1", "01-01-2020", "00:00:30"), beat("Z2-H1", "21-01-2020", "00:00:30"),
                 beat("Z2-H3", "01-01-2099", "00:00:00"), beat("Z2-H4", "02-01-1970", "00:00:00"))
    out = jobs.tester_silence(lines, devices, 60).groupBy("eqp_id", "status").count().collect()
    windows = 20 * 24 * 60 + 1
    assert {(r.eqp_id, r.status): r["count"] for r in out} == {("Z2-H1", 1): 2, ("Z2-H1", 0): windows - 2, ("Z2-H2", 0): windows}
    assert {(r.eqp_id, r.reason) for r in jobs.tester_clock_faults(lines).collect()} == {("Z2-H3", "ahead"), ("Z2-H4", "default")}


def test_tester_defaults(spark):
    out = jobs.tester_outputs(feed(spark, {"data": {"eqp_id": "Z1-H1", "Comment": "abcc by", "BIN": "100"}}, {"data": {}}, {"x": 1},
                                   {"data": {"eqp_id": "Z1-H1", "TestDate": "99-99-2020"}}))
    row = out["detail"].first()
    assert out["full"].count() == 1 and len(out["full"].columns) == 128 and len(out["detail"].columns) == 32
    assert (row.begin_time, row.order_type, row.bin_type, row.factory) == ("1970-01-01 00:00:00", "BY", "100", "2")


def test_furnace_log_takes_the_last_boat(spark):
    data = {"EqpID": "Z2-DF02", "TubeID": "T1", "updatetime": "2020-01-01 00:00:00", "Boat2@Tube%String": "DF02",
            "Boat2@BoatID%String": "b2", "Boat11@Tube%String": "DF02", "Boat11@BoatID%String": "b11"}
    rows = jobs.wide.parse_furnace_log(feed(spark, {"data": data}, {"data": {**data, "TubeID": ""}}, {"other": 1}))
    assert [r.boat_id for r in rows.orderBy("seq").collect()] == ["b11", ""]


def snapshot(**more):
    return {"EqpID": "Z2-DF01", "PutTime": "2020-01-01 09:00:00", **{f"Tube{n}.RunCount": str(n) for n in range(1, 6)}, **more}


def boat(n, tube, state="Processing", boat_id="b"):
    return {f"Boat{n}.Tube": tube, f"Boat{n}.LoadState": state, f"Boat{n}.BoatID": boat_id}


def test_tube_boats(spark):
    lines = [snapshot(**boat(1, "DF01-1"), **boat(2, "DF02-1"), **boat(12, "DF01-3", "Cooling"), **boat(4, "DF01-9"),
                      **boat(5, "DF01-2", "Loading", ""))]
    v1, v2 = (jobs.tube_boats(feed(spark, *lines), v).collect() for v in (1, 2))
    assert [(r.tube_id, r.run_count) for r in v1] == [("DF01-1", "1")]
    assert sorted((r.tube_id, r.row_key.split("|")[4]) for r in v2) == [("DF01-1", "3"), ("DF01-3", "6")]


def test_tube_boats_drop_repeats(spark):
    lines = [snapshot(**boat(1, "DF01-1")), {**snapshot(**boat(1, "DF01-1")), "PutTime": "2020-01-01 10:59:59"},
             {**snapshot(**boat(1, "DF01-1")), "PutTime": "2020-01-01 11:00:00"}, {"EqpID": "Z2-DF01", "PutTime": "2020-01-01 09:00:00"}]
    assert [r.seq for r in jobs.tube_boats(feed(spark, *lines), 3).collect()] == [0]
    assert sorted(r.seq for r in jobs.tube_boats(feed(spark, *lines), 3, ttl_seconds=7200).collect()) == [0, 2]


def test_loss_bands(spark):
    from shiftlake.operators.lookup import standard_times
    df = spark.createDataFrame([("e", "t", 1000 + n) for n in (599, 600, 1800, 1801)] + [("x", "t", 5)],
                               "eqpid string, tubeid string, ct bigint")
    dim = spark.createDataFrame([("e", "t", 1000, 0)], "eqpid string, tubeid string, st bigint, setst bigint")
    got = {r.ct: (r.st, r.loss, r.sertue) for r in standard_times(df, dim).collect()}
    assert got == {1599: (1000, 599, "Function"), 1600: (1000, 600, "Jam"), 2800: (1000, 1800, "Jam"),
                   2801: (1000, 1801, "Trouble"), 5: (0, 0, None)}


def test_changes(spark):
    lines = [{"op": "c", "after": {"id": 1, "v": "a"}}, {"op": "u", "before": {"id": 1, "v": "a"}, "after": {"id": 1, "v": "b"}},
             {"op": "c", "after": {"id": 2}}, {"op": "d", "before": {"id": 2}}, {"other": 1}]
    rows = changes.parse_changes(feed(spark, *lines))
    unpacked = changes.unpack_changes(rows).where("seq = 1").collect()
    assert sorted((r.change, r.side, r.field, r.field_value) for r in unpacked) == [
        ("UPDATE", "after", "id", "1"), ("UPDATE", "after", "v", "b"), ("UPDATE", "before", "id", "1"), ("UPDATE", "before", "v", "a")]
    assert [(r.id, r.after["v"]) for r in changes.latest_state(rows, "id", ["seq"]).collect()] == [("1", "b")]


def test_log_lines_by_host_or_as_one(spark):
    def line(host, second, text):
        return {"host": {"name": host}, "log": {"file": {"path": "/p"}}, "message": f"07/30/2020 10:00:{second:02d} {text}"}

    lines = feed(spark, line("a", 1, "Recipe Start Recipe: x"), line("b", 2, "noise"), line("a", 3, "Recipe End Recipe: x"),
                 {"host": {"name": "a"}, "message": "no time here"})
    assert [(r.host, r.kind, r.n_lines) for r in jobs.furnace_log_merge(lines).collect()] == [("a", "merged", 2)]
    assert [(r.kind, r.n_lines) for r in jobs.furnace_log_merge(lines, by=()).collect()] == [("merged", 3)]


def test_extra_step_rule(spark):
    from shiftlake.operators.steps import STEP_RULES, StepRule
    line = {"eqpid": "Z2-XX01", "tubeid": "t", "puttime": "2020-01-01 00:00:00", "_text1_": " Begin NOW "}
    assert jobs.step_feed(feed(spark, line)).count() == 0
    rules = (*STEP_RULES, StepRule("XX", "contains", "NOW", "LOAD"))
    assert jobs.step_feed(feed(spark, line), rules=rules).first().step == "LOAD"
    pe = {**line, "eqpid": "Z2-PE01", "_text1_": "the end of process is near"}
    assert jobs.step_feed(feed(spark, pe)).first().step == "CHANGE"
    assert jobs.step_feed(feed(spark, {**pe, "eqpid": "Z2-PR01"}, {**pe, "eqpid": "Z2-PR01", "_text1_": "End of process"})).count() == 0


def test_tester_lines_of_odd_shapes(spark):
    inner = '{"eqp_id":"Z2-CT01","TestDate":"05-01-2024","TestTime":"10:00:07","Uoc":"7"}'
    quoted = inner.replace('"', '\\"')
    lines = [f'{{"data":{inner}}}', f'{{"data":"{quoted}"}}', '{"data":{}}', '{"data":null}', '{"data":[1]}', '{"data":"x"}', "", None, '{"data":',
             '{"data":{"Uoc":"8"}}', '{"other":1}']
    feed = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    got = {r.seq: (r.eqp_id, r.begin_time, r.uoc) for r in wide.parse_tester(feed).collect()}
    assert got == {0: ("Z2-CT01", "2024-01-05 10:00:07", "7"), 1: ("Z2-CT01", "2024-01-05 10:00:07", "7"), 9: ("", "1970-01-01 00:00:00", "8")}


def test_tester_columns_are_written_once(spark):
    """Behind the parsed record one projection makes all columns, and the time of a line is read once."""
    plan = jobs.tester_outputs(feed(spark, {"data": {"eqp_id": "Z1-H1"}}))["full"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(begin_time") == 1
    assert sum(line.lstrip(" +-:").startswith("Project") and "uniqueid#" in line for line in plan.split("\n")) == 1
