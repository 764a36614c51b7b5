"""Raw JSON feeds built from the given tables, one line per table row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import format_second
from ..operators.measurements import DEFECTS
from ..operators.steps import STEP_RULES, STEPS
from ..operators.wide import TESTER_KEYS

SITES = ("Z2", "T1", "G1", "Z1")
TYPES = ("DF", "PE", "PR", "TA")
MODULES = (*codes.MODULE_IDS, "UNKNOWN")
LOAD_STATES = (*codes.LOAD_STATE_CODES, "Idle")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...] | list[str], index: Column) -> Column:
    listed = F.expr("array(" + ", ".join(codes.quoted(v) for v in values) + ")")
    return F.get(listed, (index % len(values)).cast("int"))


def device_id(number: Column) -> Column:
    """Equipment id of a numbered device."""
    return F.concat(pick(SITES, number), F.lit("-"), pick(TYPES, F.floor(number / 4)),
                    F.lpad((number % 100).cast("string"), 2, "0"))


def tube_id(number: Column) -> Column:
    return F.concat(F.lit("Tube"), (number % 5 + 1).cast("string"))


def device_events(events: DataFrame) -> DataFrame:
    """The event table with the telemetry fields derived from it.

    Every 17th device has a malformed id; three of a hundred rows have a
    malformed line (k = 97), an impossible date (98) or no time (99).
    """
    number = F.col("user_id")
    rows = events.select(
        F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at"), "user_id", "event_type",
        "value", F.regexp_extract("props", r"\d+", 0).cast("int").alias("k"))
    rows = rows.select(
        "*",
        F.when(number % 17 == 0, F.concat(F.lit("1"), device_id(number))).otherwise(device_id(number)).alias("eqpid"),
        pick(TYPES, F.floor(number / 4)).alias("eqp_type"),
        tube_id(number).alias("tubeid"),
        pick(STEPS, F.col("k")).alias("step"),
        F.when(F.col("k") == 98, F.lit("2024-13-45 00:00:00")).when(F.col("k") == 99, F.lit(" "))
        .otherwise(format_second(F.col("at"))).alias("puttime"))
    texts = codes.text_map({f"{r.eqp_type}|{r.step}": r.text for r in STEP_RULES})
    return rows.select("*", F.try_element_at(texts, F.concat_ws("|", "eqp_type", "step")).alias("text1"))


def lines(rows: DataFrame, fields: dict[str, Column], *kept: str, wrap: str | None = None) -> DataFrame:
    """Rows -> ``value`` (JSON of ``fields``, below ``wrap`` if given), ``seq`` and ``kept``."""
    body = F.struct(*[c.alias(n) for n, c in fields.items()])
    text = F.to_json(F.struct(body.alias(wrap)) if wrap else body)
    if "k" in rows.columns:
        text = F.when(F.col("k") == 97, F.lit('{"EqpID": broken')).otherwise(text)
    return rows.select(text.alias("value"), "seq", *kept)


def loader_feed(events: DataFrame) -> DataFrame:
    """Loader lines; in some of them clashing id keys, a factory, or no note."""
    k = F.col("k")
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "eqpid": F.when(k % 10 == 3, F.lit("X9-ZZ99")), "TubeID": F.col("tubeid"),
        "PutTime": F.col("puttime"), "Tube2Text1": F.col("text1"), "RunCount": k.cast("string"),
        "Factory": F.when(k % 10 == 0, F.lit("9")), "Note": F.when(k % 2 == 0, F.lit("even")),
    }, "event_type")


def stepped_feed(events: DataFrame) -> DataFrame:
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "TubeID": F.col("tubeid"), "PutTime": F.col("puttime"),
        "Tube2Text1": F.col("text1"), "RunCount": F.col("k").cast("string"), "State": F.col("event_type"),
    })


STEP_MAPPING = {"tube2text1": "_text1_", "state": "_states_"}


def module_feed(events: DataFrame) -> DataFrame:
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "PutTime": F.col("puttime"), "ModuleName": pick(MODULES, F.col("k")),
        "E10State": F.col("event_type"), "StatusCode": F.col("k").cast("string"),
    })


def furnace_feed(events: DataFrame) -> DataFrame:
    """Furnace log lines; boats 2 and 5 sit in the device's own tube at times."""
    k, own = F.col("k"), F.right("eqpid", F.lit(4))
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "TubeID": F.col("tubeid"), "updatetime": F.col("puttime"),
        "Tube2Text1": F.col("text1"), "RunCount": k.cast("string"),
        "Tube2@E10State%Integer": (k % 7).cast("string"),
        "Tube2@DataVar@All@Recipe%String": F.concat(F.lit("R"), (k % 3).cast("string")),
        "Boat2@Tube%String": F.when(k % 2 == 0, own).otherwise(F.lit("XX99")),
        "Boat2@BoatID%String": F.concat(F.lit("B2-"), k.cast("string")),
        "Boat5@Tube%String": F.when(k % 3 == 0, own).otherwise(F.lit("YY99")),
        "Boat5@BoatID%String": F.concat(F.lit("B5-"), k.cast("string")),
    }, wrap="data")


def heartbeat_feed(events: DataFrame) -> DataFrame:
    at = F.col("at")
    filled = ~F.col("k").isin(98, 99)
    return lines(device_events(events), {
        "eqp_id": F.col("eqpid"),
        "TestDate": F.when(filled, F.date_format(at, "dd-MM-yyyy")),
        "TestTime": F.when(filled, F.date_format(at, "HH:mm:ss")),
    }, wrap="data")


def listed_devices(supplier: DataFrame) -> DataFrame:
    """Device list of the silence alarm: numbered devices, some of which never report."""
    return supplier.select(device_id(F.col("s_suppkey") * 3).alias("eqp_id")).distinct()


def defect_lines(events: DataFrame) -> DataFrame:
    """Defect feed with material ids of 23, 24 and 25 characters."""
    number, k = F.col("user_id"), F.col("k")
    digits = F.lpad((number % 40).cast("string"), 4, "0")
    area = F.when(number % 3 == 0, F.lit("A1")).otherwise(F.lit("C"))
    tail = F.when(k == 50, F.lit("Z2#0001")).otherwise(F.lit("Z2#00012"))
    material = F.concat(F.lit("WAFRDF02-1B"), digits, area, tail, F.lit(" lot7"))
    classes = [d.title() if i % 2 else d for i, d in enumerate(DEFECTS)] + ["ok"]
    return lines(device_events(events), {
        "EquipmentID": F.concat(F.lit("GP-"), F.col("eqpid")), "EqMtlId": material,
        "Cls_CellQ": pick(classes, k), "Cls_ColQ": pick(classes, F.floor(k / 5)),
        "Come": F.col("puttime"),
    })


def alarm_feed(events: DataFrame) -> DataFrame:
    """Alarm lines: some cleared, three time formats, the tube named in slot 2 or 4."""
    k, at = F.col("k"), F.col("at")
    time = (F.when(k % 3 == 0, F.date_format(at, "yyyy/MM/dd HH:mm:ss"))
            .when(k % 3 == 1, F.date_format(at, "yyyyMMddHHmmss")).otherwise(format_second(at)))
    rows = device_events(events).withColumn("mixed", F.when(k.isin(98, 99), F.col("puttime")).otherwise(time))
    status = F.concat(F.lit("S"), (k % 4).cast("string"))
    return lines(rows, {
        "EqpID": F.col("eqpid"), "PutTime": F.col("mixed"), "Status": status,
        "AlarmText": F.when(k % 5 == 0, F.lit("Alarm CLEARED by operator")).otherwise(F.lit("Door open")),
        "AlarmCode": F.when(k % 11 > 0, F.col("k").cast("string")),
        "TubeID1": F.lit("S9"), "TubeID2": F.when(k % 2 == 0, status), "TubeID4": status,
    })


def plain_alarm_feed(events: DataFrame) -> DataFrame:
    k = F.col("k")
    status = F.concat(F.lit("S"), (k % 4).cast("string"))
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "PutTime": F.col("puttime"), "Status": status,
        "TubeID1": F.lit("S9"), "TubeID2": F.when(k % 2 == 0, status),
        "TubeID4": F.when(k % 5 > 0, status),
    })


def status_feed(events: DataFrame) -> DataFrame:
    """Status changes with times in mixed formats; a device key is missing in some."""
    k, at = F.col("k"), F.col("at")
    new = (F.when(k == 98, F.lit("junk")).when(k % 2 == 0, F.date_format(at, "yyyy/MM/dd HH:mm:ss"))
           .otherwise(format_second(at)))
    old = F.date_format(F.timestamp_seconds(F.unix_timestamp(at) - 600), "yyyyMMddHHmmss")
    return lines(device_events(events), {
        "EqpID": F.col("eqpid"), "NewStatus": F.col("event_type"), "OldStatus": F.lit("IDLE"),
        "NewTime": new, "OldTime": F.when(k != 96, old), "TubeID": F.col("tubeid"),
    })


def log_feed(events: DataFrame) -> DataFrame:
    """Shipped log lines of four hosts: click opens a recipe, purchase ends it."""
    number = F.col("user_id")
    text = (F.when(F.col("event_type") == "click", F.lit("Recipe START recipe: a"))
            .when(F.col("event_type") == "purchase", F.lit("Recipe END recipe: a"))
            .otherwise(F.col("event_type")))
    stamp = F.when(F.col("k") == 98, F.lit("99/99/2024 00:00:00")).otherwise(
        F.date_format("at", "MM/dd/yyyy HH:mm:ss"))
    rows = device_events(events)
    message = F.concat_ws(" ", stamp, F.col("seq").cast("string"), text)
    return lines(rows, {
        "host": F.struct(pick(SITES, number).alias("name")),
        "log": F.struct(F.struct(F.lit("/var/log/furnace").alias("path")).alias("file")),
        "message": message,
    })


def boat_feed(lineitem: DataFrame) -> DataFrame:
    """One wide snapshot per line item: slot n holds a boat in an own tube, slot n+5 another one."""
    order, slot = F.col("l_orderkey"), F.col("l_linenumber")
    part = F.col("l_partkey")
    own = F.concat(F.lit("DF"), F.lpad((order % 20).cast("string"), 2, "0"), F.lit("-"))
    tube = (part % 5 + 1).cast("string")
    fields = {
        "EqpID": F.concat(F.lit("Z2-DF"), F.lpad((order % 20).cast("string"), 2, "0")),
        "PutTime": format_second(F.col("l_shipdate").cast("timestamp")),
    }
    for n in range(1, 6):
        fields[f"Tube{n}.RunCount"] = F.when((part + n) % 9 > 0, (part % 7 + n).cast("string"))
    for n in range(1, 13):
        first, second = slot == n, slot + 5 == n
        fields[f"Boat{n}.Tube"] = F.when(first, F.concat(own, tube)).when(
            second, F.when(part % 3 == 0, F.concat(F.lit("XX-"), tube)).otherwise(F.concat(own, F.lit("2"))))
        fields[f"Boat{n}.BoatID"] = F.when(first | second, F.concat(F.lit("B"), (order % 50).cast("string"), F.lit("-"), F.lit(n)))
        fields[f"Boat{n}.LoadState"] = F.when(first, pick(LOAD_STATES, part)).when(second, F.lit("Processing"))
        fields[f"Boat{n}.Recipe"] = F.when(first | second, F.col("l_returnflag"))
    rows = lineitem.withColumn("seq", order * 10 + slot)
    return lines(rows, fields)


def measurement_feed(lineitem: DataFrame) -> DataFrame:
    """Material events for three of four line items, equipment states for the rest."""
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    come = format_second(F.col("l_shipdate").cast("timestamp"))
    eqp = F.concat(F.lit("Z2-GP"), F.lpad((F.col("l_suppkey") % 10).cast("string"), 2, "0"))
    is_state = line % 4 == 0

    def meas(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("@Id"), text.alias("#text"))

    values = F.array(meas("Cls_CellQ", F.concat(F.lit(" "), F.col("l_returnflag"), F.lit("\\n"))),
                     meas("Qty", F.col("l_quantity").cast("int").cast("string")))
    mtl = F.struct(
        F.concat(F.lit("M"), part.cast("string")).alias("@EqMtlId"),
        F.when(part % 10 > 0, come).alias("@Come"),
        F.struct(F.struct(F.lit("T1").alias("@ToolId"), values.alias("MeasVal")).alias("MeasVals")).alias("MeasValsList"))
    material = F.struct(
        F.struct(part.cast("string").alias("@ImageProcessingTime_ms"),
                 line.cast("string").alias("@ClassificationProcessingTime_ms")).alias("JobMd"),
        F.struct(F.lit("Evt").alias("@Name"), F.struct(mtl.alias("Mtl")).alias("MtlList")).alias("MtlEvt"))
    state = F.struct(F.struct(
        eqp.alias("@EqId"),
        F.struct(F.struct(F.col("l_linestatus").alias("@Id"), come.alias("@Come")).alias("State")).alias("States")
    ).alias("Eq"))
    rows = lineitem.withColumn("seq", F.col("l_orderkey") * 10 + line)
    return lines(rows, {
        "EquipmentID": eqp,
        "Data": F.struct(F.when(~is_state, material).alias("MtlEvtData"), F.when(is_state, state).alias("EqState")),
    })


def tester_feed(lineitem: DataFrame) -> DataFrame:
    """Cell tester records with every key; some without a date, and order codes in the comment."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    at = F.col("l_shipdate").cast("timestamp")
    site = pick(("G1", "Z1", "Z2", "Z3", "T1", "X1"), order)
    code = pick(("yp", "PL-BY", "by", "xYZ", "LY", "cfx", "cc", "GSQ", "gsh", "CID", "none"), part)
    rows = lineitem.withColumn("seq", order * 10 + line)
    filled = {k: F.when((order + i) % 5 > 0, ((part + i) % 97).cast("string")) for i, k in enumerate(TESTER_KEYS)}
    return lines(rows, filled | {
        "eqp_id": F.concat(site, F.lit("-CT"), F.lpad((part % 30).cast("string"), 2, "0")),
        "TestDate": F.when(line != 7, F.date_format(at, "dd-MM-yyyy")),
        "TestTime": F.when(line != 6, F.concat_ws(
            ":", F.lpad((part % 24).cast("string"), 2, "0"), F.lpad((order % 60).cast("string"), 2, "0"), F.lit("07"))),
        "BIN": F.when(part % 4 == 0, F.lit("100")).when(part % 4 == 1, F.lit("0")).otherwise((part % 9).cast("string")),
        "Comment": F.concat(F.lit("lot "), code), "UniqueID": F.concat_ws("-", order.cast("string"), line.cast("string")),
        "BatchID": (order % 1000).cast("string"), "Uoc": F.col("l_quantity").cast("int").cast("string"),
        "EL2Line": F.col("l_linestatus"), "IRev2": F.col("l_returnflag"),
    }, wrap="data")


def change_feed(orders: DataFrame) -> DataFrame:
    """Change envelopes: an order row is a read, create, update or delete of its customer's record."""
    key, old = F.col("o_orderkey"), F.lit("old")
    op = pick(("r", "c", "u", "u", "d"), key)

    def image(status: Column) -> Column:
        return F.struct(F.col("o_custkey").cast("string").alias("id"), status.alias("status"),
                        F.col("o_orderpriority").alias("priority"))

    return orders.select(
        F.to_json(F.struct(
            op.alias("op"),
            F.when(op.isin("u", "d"), image(old)).alias("before"),
            F.when(op.isin("r", "c", "u"), image(F.col("o_orderstatus"))).alias("after"),
        )).alias("value"),
        key.alias("seq"), F.col("o_orderdate").cast("timestamp").alias("ts"))


def standard_time_table(customer: DataFrame) -> DataFrame:
    """Standard times per device and tube; devices that no customer maps to have none."""
    n = F.col("c_custkey")
    return customer.select(
        device_id(n).alias("eqpid"), tube_id(n).alias("tubeid"),
        (F.col("c_nationkey").cast("long") * 7200).alias("st"),
        (F.col("c_nationkey").cast("long") * 3600 + n % 100).alias("setst"))
