"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from ..operators.counters import counter_name
from ..operators.measurements import DEFECTS
from ..operators.steps import STEP_RULES, STEPS
from ..operators.wide import NOT_IN_FULL, TESTER_DETAIL, TESTER_KEYS, tester_column
from .feeds import LOAD_STATES, MODULES, SITES, TYPES

SECOND = "'%Y-%m-%d %H:%M:%S'"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({_list(values)})[CAST(({index}) % {len(values)} AS INT) + 1]"


def device(n: str) -> str:
    return f"({pick(SITES, n)} || '-' || {pick(TYPES, f'{n} // 4')} || lpad(CAST({n} % 100 AS VARCHAR), 2, '0'))"


def tube(n: str) -> str:
    return f"('Tube' || CAST({n} % 5 + 1 AS VARCHAR))"


def fmt(ts: str) -> str:
    return f"strftime({ts}, {SECOND})"


def offset(site: str) -> str:
    return f"(CASE left({site}, 1) WHEN 'G' THEN INTERVAL 450 MINUTE WHEN 'Z' THEN INTERVAL 480 MINUTE WHEN 'T' THEN INTERVAL 480 MINUTE END)"


def shift(ts: str, site: str) -> str:
    u = f"({ts} - {offset(site)})"
    return f"(strftime({u}, '%Y-%m-%d') || CASE WHEN hour({u}) < 12 THEN '-D' ELSE '-N' END)"


def shift_start(ts: str, site: str) -> str:
    u = f"({ts} - {offset(site)})"
    return (f"(date_trunc('day', {u}) + {offset(site)} + CASE WHEN hour({u}) < 12 THEN INTERVAL 0 HOUR "
            f"ELSE INTERVAL 12 HOUR END)")


def day_date(ts: str) -> str:
    return f"strftime({ts} - INTERVAL 8 HOUR, '%Y-%m-%d')"


def factory(site: str) -> str:
    return f"(CASE {site} WHEN 'Z2' THEN '4' WHEN 'Z3' THEN '4' WHEN 'T1' THEN '3' WHEN 'G1' THEN '1' ELSE 'Other' END)"


def tester_factory(site: str) -> str:
    return (f"(CASE {site} WHEN 'G1' THEN '1' WHEN 'Z1' THEN '2' WHEN 'T1' THEN '3' WHEN 'Z2' THEN '4' "
            f"WHEN 'Z3' THEN '4' ELSE 'Other' END)")


def row_key(joined: str) -> str:
    return f"(left(md5({joined}), 2) || '|' || {joined})"


def week(day: str) -> str:
    """``day`` is a date; Monday-start week holding 1 January is week 1."""
    monday = f"CAST(date_trunc('week', {day}) AS DATE)"
    first = f"CAST(date_trunc('week', make_date(year({monday} + 6), 1, 1)) AS DATE)"
    return f"lpad(CAST(({monday} - {first}) // 7 + 1 AS VARCHAR), 2, '0')"


_text1 = "CASE " + " ".join(
    f"WHEN eqp_type = '{r.eqp_type}' AND step = '{r.step}' THEN '{r.text}'" for r in STEP_RULES) + " END"
NEXT = "CASE step " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in zip(STEPS, STEPS[1:] + STEPS[:1])) + " END"

# f: every event with its telemetry fields; v: those a loader accepts.
BASE = f"""
g AS (SELECT event_id AS seq, ts AS raw_at, date_trunc('second', ts) AS ts, user_id, event_type, value,
             CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events),
h AS (SELECT *, {device('user_id')} AS good_id, {pick(TYPES, 'user_id // 4')} AS eqp_type,
             {tube('user_id')} AS tubeid, {pick(STEPS, 'k')} AS step FROM g),
f AS (SELECT *, CASE WHEN user_id % 17 = 0 THEN '1' || good_id ELSE good_id END AS eqpid,
             left(good_id, 2) AS site, {fmt('ts')} AS puttime, CAST(k AS VARCHAR) AS runcount, {_text1} AS text1 FROM h),
v AS (SELECT * FROM f WHERE k < 97 AND user_id % 17 <> 0)
"""

SQL: dict[str, str] = {}

# Loading and enrichment ----------------------------------------------------

SQL["normalize_filter"] = f"""
WITH {BASE} SELECT seq, eqpid, tubeid, puttime, text1, runcount, CASE WHEN k % 2 = 0 THEN 'even' END AS note FROM v
"""
SQL["normalize_snake"] = f"""
WITH {BASE} SELECT seq, eqpid AS eqp_id, tubeid AS tube_id,
  CASE k WHEN 98 THEN '2024-13-45 00:00:00' WHEN 99 THEN ' ' ELSE puttime END AS put_time,
  text1, runcount AS run_count, 'Old_Status_Date' AS sample FROM f WHERE k <> 97
"""
SQL["rejected_lines"] = f"""
WITH {BASE} SELECT seq, CASE WHEN k = 97 THEN 'malformed' WHEN user_id % 17 = 0 THEN 'bad_id'
  WHEN k = 99 THEN 'blank_time' ELSE 'bad_time' END AS reason
FROM f WHERE k >= 97 OR user_id % 17 = 0
"""
SQL["enrich_standard"] = f"""
WITH {BASE} SELECT seq, eqpid, site, CASE WHEN k % 10 = 0 THEN '9' ELSE {factory('site')} END AS factory,
  {day_date('ts')} AS day_date, {shift('ts', 'site')} AS shift,
  CAST(CAST(epoch(ts) AS BIGINT) - 28800 AS VARCHAR) AS long_time,
  {row_key("(eqpid || '|' || puttime || '|' || tubeid)")} AS row_key FROM v
"""
SQL["calendar_labels"] = f"""
WITH c AS (SELECT o_orderkey, {pick(('G1', 'Z2', 'T1', 'X1'), 'o_custkey')} AS site,
             o_orderdate + to_seconds((o_orderkey * 600) % 86400) AS ts FROM orders),
d AS (SELECT *, {day_date('ts')} AS day_date FROM c)
SELECT o_orderkey, site, day_date, {shift('ts', 'site')} AS shift, right({shift('ts', 'site')}, 1) AS shift_char,
  {fmt(f"({shift_start('ts', 'site')} + INTERVAL 12 HOUR)")} AS next_switch,
  'Y' || left(day_date, 4) AS year, 'M' || substr(day_date, 6, 2) AS month,
  'W' || {week('CAST(day_date AS DATE)')} AS week, {factory('site')} AS factory FROM d
"""
SQL["routed_upsert"] = f"""
WITH {BASE} SELECT seq, event_type AS topic,
  CASE event_type WHEN 'view' THEN 't_view' WHEN 'click' THEN 't_click' ELSE 't_sale' END AS target, 'cf' AS family,
  {row_key("(eqpid || '|' || puttime || '|' || tubeid)")} AS row_key
FROM v WHERE event_type IN ('view', 'click', 'purchase')
"""

# Step efficiency ------------------------------------------------------------

RUNS = f"""
{BASE},
r1 AS (SELECT *, CASE WHEN step IS DISTINCT FROM lag(step) OVER w THEN 1 ELSE 0 END AS fresh FROM v
       WINDOW w AS (PARTITION BY eqpid, tubeid ORDER BY ts, seq)),
r2 AS (SELECT *, sum(fresh) OVER (PARTITION BY eqpid, tubeid ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS run FROM r1),
r3 AS (SELECT *, row_number() OVER (PARTITION BY eqpid, tubeid, run ORDER BY ts, seq) AS nth,
         row_number() OVER (PARTITION BY eqpid, tubeid, run
           ORDER BY CASE WHEN eqp_type = 'DF' THEN NULL ELSE ts END DESC NULLS LAST,
                    CASE WHEN eqp_type = 'DF' THEN ts END, seq) AS rank FROM r2),
heads AS (SELECT *, lead(ts) OVER w AS close_ts, lead(step) OVER w AS close_step, lead(runcount) OVER w AS close_count
          FROM r3 WHERE nth = 1 WINDOW w AS (PARTITION BY eqpid, tubeid ORDER BY run)),
closed AS (SELECT p.eqpid, p.tubeid, p.site, p.eqp_type, p.step, p.ts, p.seq, p.runcount, p.event_type AS states, p.run,
             h.ts AS head_ts, h.close_ts, h.close_step, h.close_count
           FROM r3 p JOIN heads h USING (eqpid, tubeid, run) WHERE p.rank = 1 AND h.close_ts IS NOT NULL)
"""
_data_type = f"CASE WHEN close_step = {NEXT} THEN 'Y' ELSE 'N' END"
SQL["step_intervals"] = f"""
WITH {RUNS}
SELECT eqpid, tubeid, step, close_step AS step_name, {_data_type} AS data_type, {fmt('ts')} AS put_time,
  {fmt('close_ts')} AS end_time, CAST(epoch(close_ts) - epoch(ts) AS BIGINT) AS ct, runcount,
  close_count AS run_count_next, site, {factory('site')} AS factory, {day_date('ts')} AS day_date,
  {shift('ts', 'site')} AS shift, {row_key(f"(eqpid || '|' || {fmt('ts')})")} || '|' || tubeid AS row_key, states
FROM closed
"""
SQL["step_intervals_lookup"] = f"""
WITH {RUNS},
dims AS (SELECT {device('c_custkey')} AS eqpid, {tube('c_custkey')} AS tubeid, CAST(c_nationkey AS BIGINT) * 7200 AS st,
           CAST(c_nationkey AS BIGINT) * 3600 + c_custkey % 100 AS setst FROM customer),
dim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY eqpid, tubeid ORDER BY st DESC, setst DESC) AS n FROM dims)
        WHERE n = 1),
j AS (SELECT c.*, d.st, d.setst, CAST(epoch(close_ts) - epoch(ts) AS BIGINT) AS ct
      FROM closed c LEFT JOIN dim d ON c.eqpid = d.eqpid AND c.tubeid = d.tubeid)
SELECT eqpid, tubeid, {fmt('ts')} AS put_time, step, ct, coalesce(st, 0) AS st, coalesce(ct - st, 0) AS loss,
  CASE WHEN ct - st < 600 THEN 'Function' WHEN ct - st > 1800 THEN 'Trouble' WHEN st IS NOT NULL THEN 'Jam' END AS sertue,
  coalesce(setst, 0) AS set_st, coalesce(ct - setst, 0) AS set_st_loss,
  CASE WHEN ct - setst < 600 THEN 'Function' WHEN ct - setst > 1800 THEN 'Trouble' WHEN setst IS NOT NULL THEN 'Jam' END
    AS set_st_sertue
FROM j
"""
SQL["step_intervals_by_shift"] = f"""
WITH {RUNS},
span AS (SELECT *, {shift_start('head_ts', 'site')} AS first_shift FROM closed),
parts AS (SELECT eqpid, tubeid, run, site, eqp_type, step, head_ts, close_ts, close_step, first_shift,
            unnest(generate_series(first_shift, greatest(close_ts - INTERVAL 1 SECOND, first_shift), INTERVAL 12 HOUR)) AS s
          FROM span),
member AS (SELECT eqpid, tubeid, run, ts, seq, runcount, {shift_start('ts', 'site')} AS s,
             row_number() OVER (PARTITION BY eqpid, tubeid, run, {shift_start('ts', 'site')}
               ORDER BY CASE WHEN eqp_type = 'DF' THEN NULL ELSE ts END DESC NULLS LAST,
                        CASE WHEN eqp_type = 'DF' THEN ts END, seq) AS n,
             nth, eqp_type FROM r3),
rep AS (SELECT * FROM member WHERE n = 1 AND (eqp_type <> 'DF' OR nth = 1)),
filled AS (SELECT p.*, r.ts AS rep_ts,
             last_value(r.ts IGNORE NULLS) OVER w AS orig_start,
             last_value(r.runcount IGNORE NULLS) OVER w AS runcount
           FROM parts p LEFT JOIN rep r USING (eqpid, tubeid, run, s)
           WINDOW w AS (PARTITION BY p.eqpid, p.tubeid, p.run ORDER BY p.s ROWS UNBOUNDED PRECEDING)),
piece AS (SELECT *, coalesce(rep_ts, s) AS start_ts, s + INTERVAL 12 HOUR AS b FROM filled),
done AS (SELECT *, CASE WHEN b >= close_ts THEN close_ts ELSE b END AS end_ts,
           CASE WHEN b >= close_ts THEN close_step ELSE {NEXT} END AS step_name FROM piece)
SELECT eqpid, tubeid, step, step_name, CASE WHEN step_name = {NEXT} THEN 'Y' ELSE 'N' END AS data_type,
  {fmt('start_ts')} AS put_time, {fmt('end_ts')} AS end_time,
  CAST(epoch(end_ts) - epoch(start_ts) AS BIGINT) AS ct, runcount, {fmt('orig_start')} AS orig_start,
  {day_date('start_ts')} AS day_date, right({shift('start_ts', 'site')}, 1) AS shift,
  'Y' || left({day_date('start_ts')}, 4) AS year, 'M' || substr({day_date('start_ts')}, 6, 2) AS month,
  'W' || {week(f"CAST({day_date('start_ts')} AS DATE)")} AS week,
  {row_key(f"(eqpid || '|' || {fmt('start_ts')} || '|' || tubeid)")} AS row_key
FROM done
"""

LOADED = f"""
{BASE},
r AS (SELECT *, {row_key("(eqpid || '|' || puttime || '|' || tubeid)")} AS row_key FROM v)
"""


LONG_TIME = "CAST(CAST(epoch(ts) AS BIGINT) - 28800 AS VARCHAR)"


def loaded(order: str, more: str = "") -> str:
    """The loaded table: the last value of every column by ``order``."""
    return f"""row_key, min({day_date('ts')}) AS day_date, min(eqpid) AS eqpid,
  arg_max(CASE WHEN k % 10 = 0 THEN '9' ELSE {factory('site')} END, {order}) AS factory, arg_max(runcount, {order}) AS runcount,
  arg_max('even', {order}) FILTER (WHERE k % 2 = 0) AS note, arg_max(text1, {order}) AS text1,
  min(tubeid) AS tubeid, min(puttime) AS puttime, min(site) AS site, min({shift('ts', 'site')}) AS shift,
  min({LONG_TIME}) AS long_time, '2024-02-01 00:00:00' AS create_time{more}"""


SQL["keyed_put"] = f"WITH {LOADED} SELECT {loaded('seq % 2 * 1000000000000 + seq')} FROM r GROUP BY row_key"
SQL["stream_keyed_load"] = f"WITH {LOADED} SELECT {loaded('seq')} FROM r GROUP BY row_key"
SQL["keyed_delete"] = f"""
WITH {LOADED} SELECT {loaded('seq')} FROM r WHERE row_key NOT IN (SELECT row_key FROM r WHERE k % 5 = 0) GROUP BY row_key
"""
_target = "CASE event_type WHEN 'view' THEN 't_view' WHEN 'click' THEN 't_click' ELSE 't_sale' END"
SQL["keyed_routed"] = f"""
WITH {LOADED} SELECT {loaded('seq', f", {_target} AS target")} FROM r
WHERE event_type IN ('view', 'click', 'purchase') GROUP BY row_key, {_target}
"""
SQL["stream_keyed_routed"] = SQL["keyed_routed"]
# Only times with dashes are read as the time of a record.
SQL["stream_keyed_status"] = f"""
WITH {BASE},
r AS (SELECT *, {row_key("(eqpid || '|' || puttime || '|' || tubeid)")} AS row_key FROM f
      WHERE k % 2 = 1 AND k <> 97 AND user_id % 17 <> 0)
SELECT row_key, min({day_date('ts')}) AS day_date, min(eqpid) AS eqpid, min(tubeid) AS tubeid, min(puttime) AS newtime,
  arg_max(event_type, seq) AS newstatus, 'IDLE' AS oldstatus, strftime(min(ts) - INTERVAL 600 SECOND, '%Y%m%d%H%M%S') AS oldtime,
  min(site) AS site, min({factory('site')}) AS factory, min({shift('ts', 'site')}) AS shift, min({LONG_TIME}) AS long_time,
  '2024-02-01 00:00:00' AS create_time
FROM r GROUP BY row_key
"""
SQL["keyed_own_key"] = f"""
WITH {BASE},
s AS (SELECT *, eqpid || '|' || puttime || '|' || tubeid AS joined FROM v),
r AS (SELECT *, {row_key('joined')} || '|' || left(sha256(concat_ws(chr(31), eqpid, puttime, runcount)), 5) AS row_key FROM s)
SELECT row_key, min({day_date('ts')}) AS day_date,
  '{{"eqpid":"' || min(eqpid) || '","puttime":"' || min(puttime) || '"}}' AS record, arg_max(k, seq) AS runcount
FROM r GROUP BY row_key
"""
SQL["stream_topic_sink"] = f"""
WITH {LOADED} SELECT seq, eqpid, puttime, text1, CASE WHEN k % 2 = 0 THEN 'even' END AS note, row_key FROM r
"""

# Benches, furnaces, boats ----------------------------------------------------

# Runs still open at the end are cut up to the last row.
MARK = "(SELECT max(ts) FROM {source})"
SQL["stream_step_intervals"] = f"""
WITH {RUNS}
SELECT eqpid, tubeid, step, close_step AS step_name, {_data_type} AS data_type, {fmt('ts')} AS put_time,
  {fmt('close_ts')} AS end_time, CAST(epoch(close_ts) - epoch(ts) AS BIGINT) AS ct, runcount,
  close_count AS run_count_next, {row_key(f"(eqpid || '|' || {fmt('ts')})")} || '|' || tubeid AS row_key
FROM closed
"""
SQL["stream_step_intervals_by_shift"] = f"""
WITH {RUNS},
lim AS (SELECT {MARK.format(source='v')} AS mark),
span AS (SELECT h.*, coalesce(close_ts, mark) AS until, {shift_start('ts', 'site')} AS first_shift FROM heads h, lim),
parts AS (SELECT eqpid, tubeid, run, site, eqp_type, step, close_ts, close_step, until,
            unnest(generate_series(first_shift, greatest(until - INTERVAL 1 SECOND, first_shift), INTERVAL 12 HOUR)) AS s
          FROM span),
member AS (SELECT eqpid, tubeid, run, ts, seq, runcount, {shift_start('ts', 'site')} AS s,
             row_number() OVER (PARTITION BY eqpid, tubeid, run, {shift_start('ts', 'site')}
               ORDER BY CASE WHEN eqp_type = 'DF' THEN NULL ELSE ts END DESC NULLS LAST,
                        CASE WHEN eqp_type = 'DF' THEN ts END, seq) AS n,
             nth, eqp_type FROM r3),
rep AS (SELECT * FROM member WHERE n = 1 AND (eqp_type <> 'DF' OR nth = 1)),
filled AS (SELECT p.*, r.ts AS rep_ts, last_value(r.ts IGNORE NULLS) OVER w AS orig_start,
             last_value(r.runcount IGNORE NULLS) OVER w AS runcount
           FROM parts p LEFT JOIN rep r USING (eqpid, tubeid, run, s)
           WINDOW w AS (PARTITION BY p.eqpid, p.tubeid, p.run ORDER BY p.s ROWS UNBOUNDED PRECEDING)),
piece AS (SELECT *, coalesce(rep_ts, s) AS start_ts, s + INTERVAL 12 HOUR AS b FROM filled),
done AS (SELECT *, CASE WHEN b >= close_ts THEN close_ts ELSE b END AS end_ts,
           CASE WHEN b >= close_ts THEN close_step ELSE {NEXT} END AS step_name FROM piece)
SELECT eqpid, tubeid, step, step_name, CASE WHEN step_name = {NEXT} THEN 'Y' ELSE 'N' END AS data_type,
  {fmt('start_ts')} AS put_time, {fmt('end_ts')} AS end_time,
  CAST(epoch(end_ts) - epoch(start_ts) AS BIGINT) AS ct, runcount, right({shift('start_ts', 'site')}, 1) AS shift,
  {row_key(f"(eqpid || '|' || {fmt('start_ts')} || '|' || tubeid)")} AS row_key, {fmt('orig_start')} AS orig_start
FROM done WHERE end_ts <= until
"""

_module_id = ("CASE modulename WHEN 'SDR' THEN '1' WHEN 'PCS 1' THEN '2' WHEN 'RINSE 1' THEN '2' WHEN 'RINSE 2' THEN '2' "
              "WHEN 'TEXTURE 1' THEN '3' WHEN 'TEXTURE 2' THEN '3' WHEN 'HU|HF' THEN '4' WHEN 'DIO3|HU' THEN '5' "
              "WHEN 'HWD' THEN '6' WHEN 'WAD 1' THEN '7' WHEN 'WAD 2' THEN '7' WHEN 'WAD 3' THEN '7' "
              "WHEN 'Unload Station' THEN '8' END")
BENCH = f"""
{BASE},
m AS (SELECT *, {pick(MODULES, 'k')} AS modulename FROM v),
n AS (SELECT *, lead(ts) OVER (PARTITION BY eqpid, modulename ORDER BY ts, seq) AS next_ts FROM m
      WHERE modulename <> 'UNKNOWN')
"""
SQL["module_intervals"] = f"""
WITH {BENCH}
SELECT eqpid, modulename, {_module_id} AS module_id, event_type AS e10state, runcount AS statuscode, puttime AS put_time,
  CASE WHEN modulename = 'Unload Station' THEN '' ELSE {fmt('next_ts')} END AS end_time,
  CASE WHEN modulename = 'Unload Station' THEN 0 ELSE CAST(epoch(next_ts) - epoch(ts) AS BIGINT) END AS ct,
  {factory('site')} AS factory, {day_date('ts')} AS day_date, {shift('ts', 'site')} AS shift,
  {row_key("(eqpid || '|' || puttime)")} AS row_key
FROM n WHERE next_ts IS NOT NULL
"""
SQL["bench_unload_split"] = f"""
WITH {BENCH}
SELECT '1' AS target, seq, eqpid, modulename, puttime AS put_time, {fmt('next_ts')} AS end_time,
  CAST(epoch(next_ts) - epoch(ts) AS BIGINT) AS ct
FROM n WHERE next_ts IS NOT NULL AND modulename <> 'Unload Station'
UNION ALL
SELECT '2', seq, eqpid, modulename, puttime, '', 0 FROM n WHERE modulename = 'Unload Station'
"""
_boat = ("CASE WHEN k % 3 = 0 THEN 'B5-' || runcount WHEN k % 2 = 0 THEN 'B2-' || runcount ELSE '' END")
_puttime = "CASE k WHEN 98 THEN '2024-13-45 00:00:00' WHEN 99 THEN ' ' ELSE puttime END"
SQL["furnace_log_parse"] = f"""
WITH {BASE}
SELECT seq, eqpid, tubeid, {_puttime} AS updatetime, text1 AS tube2_text1, runcount AS run_count,
  CAST(k % 7 AS VARCHAR) AS e10state, 'R' || CAST(k % 3 AS VARCHAR) AS datavar_all_recipe, '' AS memory_all_text2,
  {_boat} AS boat_id FROM f WHERE k <> 97
"""
SQL["cycle_pairs"] = f"""
WITH {BASE},
c AS (SELECT *, lead(ts) OVER (PARTITION BY eqpid, tubeid ORDER BY ts, seq) AS next_ts FROM f WHERE k < 97)
SELECT seq, eqpid, tubeid, puttime AS updatetime, {fmt('next_ts')} AS end_time, {_boat} AS boat_id
FROM c WHERE next_ts IS NOT NULL
"""
SQL["stream_cycle_pairs"] = f"""
WITH {BASE},
c AS (SELECT *, lead(ts) OVER (PARTITION BY eqpid, tubeid ORDER BY ts, seq) AS next_ts FROM f
      WHERE k < 97)
SELECT seq, eqpid, tubeid, puttime AS updatetime, {fmt('next_ts')} AS end_time,
  CAST(epoch(next_ts) - epoch(ts) AS BIGINT) AS ct, {_boat} AS boat_id
FROM c WHERE next_ts IS NOT NULL
"""
_codes = ("CASE load_state WHEN 'Loading' THEN '1' WHEN 'Wait for Loading/Unload' THEN '2' WHEN 'Processing' THEN '3' "
          "WHEN 'Wait for process' THEN '4' WHEN 'Cooling time elapsed' THEN '5' WHEN 'Cooling' THEN '6' ELSE '0' END")
_rc = ", ".join(f"CASE WHEN (l_partkey + {n}) % 9 > 0 THEN CAST(l_partkey % 7 + {n} AS VARCHAR) END AS rc{n}" for n in range(1, 6))
SNAPSHOTS = f"""
snap AS (SELECT l_orderkey * 10 + l_linenumber AS seq, l_orderkey, l_linenumber, l_partkey, l_returnflag,
           l_shipdate AS ts, {fmt('l_shipdate')} AS put_time,
           'Z2-DF' || lpad(CAST(l_orderkey % 20 AS VARCHAR), 2, '0') AS eqp_id,
           'DF' || lpad(CAST(l_orderkey % 20 AS VARCHAR), 2, '0') || '-' AS own, {_rc} FROM lineitem)
"""


def _slots(source: str) -> str:
    return f"""
slot AS (
  SELECT *, own || CAST(l_partkey % 5 + 1 AS VARCHAR) AS tube_id, l_partkey % 5 + 1 AS tube_no, l_linenumber AS slot_no,
    {pick(LOAD_STATES, 'l_partkey')} AS load_state FROM {source}
  UNION ALL
  SELECT *, own || '2', 2, l_linenumber + 5, 'Processing' FROM {source}
  WHERE l_partkey % 3 <> 0 AND l_linenumber + 5 <= 12),
boat AS (SELECT *, 'B' || CAST(l_orderkey % 50 AS VARCHAR) || '-' || CAST(slot_no AS VARCHAR) AS boat_id,
           CASE tube_no WHEN 1 THEN rc1 WHEN 2 THEN rc2 WHEN 3 THEN rc3 WHEN 4 THEN rc4 ELSE rc5 END AS run_count FROM slot)
"""


def _boats(key: str, where: str) -> str:
    return f"""
SELECT seq, eqp_id, put_time, tube_id, boat_id, load_state, l_returnflag AS recipe, run_count, '' AS cool_time,
  {day_date('ts')} AS day_date, {shift('ts', "'Z2'")} AS shift, {row_key(key)} AS row_key
FROM boat WHERE run_count IS NOT NULL{where}
"""


_key2 = f"(tube_id || '|' || boat_id || '|' || run_count || '|' || {_codes} || '|' || put_time)"
SQL["boat_unpivot_v1"] = (f"WITH {SNAPSHOTS}, {_slots('snap')}"
                          + _boats("(eqp_id || '|' || tube_id || '|' || boat_id || '|' || run_count)",
                                   " AND load_state = 'Processing'"))
SQL["boat_unpivot_v2"] = f"WITH {SNAPSHOTS}, {_slots('snap')}" + _boats(_key2, "")
SQL["boat_unpivot_v3"] = f"""
WITH {SNAPSHOTS},
firsts AS (SELECT * EXCLUDE n FROM (
    SELECT *, row_number() OVER (PARTITION BY eqp_id, rc1, rc2, rc3, rc4, rc5 ORDER BY ts, seq, l_partkey, l_returnflag) AS n
    FROM snap WHERE rc1 IS NOT NULL AND rc2 IS NOT NULL AND rc3 IS NOT NULL AND rc4 IS NOT NULL AND rc5 IS NOT NULL)
  WHERE n = 1), {_slots('firsts')}""" + _boats(_key2, "")
SQL["dedup_first"] = f"""
WITH {BASE}
SELECT eqpid, runcount, seq, puttime AS put_time
FROM (SELECT *, row_number() OVER (PARTITION BY eqpid, runcount ORDER BY ts, seq) AS n FROM v) WHERE n = 1
"""
SQL["dedup_ttl"] = f"""
WITH RECURSIVE {BASE},
o AS (SELECT eqpid, tubeid, CAST(epoch(ts) AS BIGINT) AS sec, seq, puttime,
        row_number() OVER (PARTITION BY eqpid, tubeid ORDER BY ts, seq) AS rn FROM v),
chain AS (
  SELECT eqpid, tubeid, rn, seq, puttime, sec AS kept_at, TRUE AS kept FROM o WHERE rn = 1
  UNION ALL
  SELECT o.eqpid, o.tubeid, o.rn, o.seq, o.puttime,
    CASE WHEN o.sec - c.kept_at >= 172800 THEN o.sec ELSE c.kept_at END, o.sec - c.kept_at >= 172800
  FROM chain c JOIN o ON o.eqpid = c.eqpid AND o.tubeid = c.tubeid AND o.rn = c.rn + 1)
SELECT eqpid, tubeid, seq, puttime AS put_time FROM chain WHERE kept
"""
BRACKETS = f"""
WITH RECURSIVE {BASE},
l AS (SELECT {pick(SITES, 'user_id')} AS host, CAST(epoch(ts) AS BIGINT) AS sec, ts, seq,
        event_type = 'click' AS s, event_type = 'purchase' AS e,
        strftime(ts, '%m/%d/%Y %H:%M:%S') || ' ' || CAST(seq AS VARCHAR) || ' ' ||
          CASE event_type WHEN 'click' THEN 'Recipe START recipe: a' WHEN 'purchase' THEN 'Recipe END recipe: a'
            ELSE event_type END AS line,
        row_number() OVER (PARTITION BY {pick(SITES, 'user_id')} ORDER BY ts, seq) AS rn FROM f WHERE k NOT IN (97, 98)),
-- at: start of the bracket a row lies in (null: outside); open: the start that is still open after the row.
st AS (
  SELECT host, rn, CASE WHEN s THEN sec END AS at, CASE WHEN s THEN rn END AS id,
    CASE WHEN s THEN sec END AS open, CASE WHEN s THEN rn END AS open_id FROM l WHERE rn = 1
  UNION ALL
  SELECT x.host, x.rn,
    CASE WHEN x.sec - p.open <= 3600 THEN p.open WHEN x.s THEN x.sec END,
    CASE WHEN x.sec - p.open <= 3600 THEN p.open_id WHEN x.s THEN x.rn END,
    CASE WHEN x.e THEN NULL WHEN x.sec - p.open <= 3600 THEN p.open WHEN x.s THEN x.sec END,
    CASE WHEN x.e THEN NULL WHEN x.sec - p.open <= 3600 THEN p.open_id WHEN x.s THEN x.rn END
  FROM st p JOIN l x ON x.host = p.host AND x.rn = p.rn + 1),
y AS (SELECT l.*, st.id FROM st JOIN l USING (host, rn))
"""
SQL["bracket_merge"] = BRACKETS + f"""
SELECT host, CASE WHEN bool_or(e) THEN 'merged' ELSE 'miss_end' END AS kind, {fmt('min(ts)')} AS begin_time,
  {fmt('max(ts)')} AS end_time, count(*) AS n_lines, string_agg(line, ' ' ORDER BY ts, seq) AS text
FROM y WHERE id IS NOT NULL GROUP BY host, id
UNION ALL
SELECT host, 'miss_begin', {fmt('ts')}, {fmt('ts')}, 1, line FROM y WHERE id IS NULL AND e
"""
SQL["stream_bracket_merge"] = SQL["bracket_merge"]

SQL["stream_dedup"] = SQL["dedup_ttl"]
SQL["stream_lookup"] = f"""
WITH {BASE},
dims AS (SELECT {device('c_custkey')} AS eqpid, {tube('c_custkey')} AS tubeid, CAST(c_nationkey AS BIGINT) * 7200 AS st,
           CAST(c_nationkey AS BIGINT) * 3600 + c_custkey % 100 AS setst FROM customer),
dim AS (SELECT eqpid, tubeid, max(st) AS st FROM dims GROUP BY eqpid, tubeid),
j AS (SELECT v.seq, v.eqpid, v.tubeid, CAST(k AS BIGINT) * 100 AS ct, d.st
      FROM v LEFT JOIN dim d ON v.eqpid = d.eqpid AND v.tubeid = d.tubeid)
SELECT seq, eqpid, tubeid, ct, coalesce(st, 0) AS st, coalesce(ct - st, 0) AS loss,
  CASE WHEN ct - st < 600 THEN 'Function' WHEN ct - st > 1800 THEN 'Trouble' WHEN st IS NOT NULL THEN 'Jam' END AS sertue
FROM j
"""

# Alarms ----------------------------------------------------------------------

SQL["silence_alarm"] = f"""
WITH {BASE},
beat AS (SELECT eqpid AS eqp_id, CAST(epoch(ts) AS BIGINT) // 3600 * 3600 AS w FROM f WHERE k < 97),
span AS (SELECT min(w) AS lo, max(w) AS hi FROM beat),
dev AS (SELECT DISTINCT {device('s_suppkey * 3')} AS eqp_id FROM supplier),
spine AS (SELECT eqp_id, unnest(generate_series((SELECT lo FROM span), (SELECT hi FROM span), 3600)) AS w FROM dev),
cell AS (SELECT eqp_id, w, CAST(sum(ok) AS INT) AS cnt FROM
           (SELECT eqp_id, w, 1 AS ok FROM beat UNION ALL SELECT eqp_id, w, 0 FROM spine) GROUP BY eqp_id, w),
o AS (SELECT *, CASE WHEN cnt > 0 THEN 1 ELSE 0 END AS status, left(eqp_id, 2) AS site,
        {fmt('make_timestamp(w * 1000000)')} AS begin_time, {fmt('make_timestamp((w + 3600) * 1000000)')} AS end_time FROM cell)
SELECT '2402010000' || replace(eqp_id, '-', '') || lpad(CAST(status AS VARCHAR), 2, '0')
    || upper(left(md5(eqp_id || '|' || begin_time), 4)) AS alarm_id,
  {factory('site')} AS factory, site, eqp_id, eqp_id AS sub_process, begin_time, end_time, status, cnt,
  CASE WHEN status = 0 THEN 'No message received for a long time(' || eqp_id || ')' END AS msg,
  '2024-02-01 00:00:00' AS create_time
FROM o
"""
SQL["tester_clock_faults"] = f"""
WITH {BASE} SELECT eqpid AS eqp_id, puttime AS ts, 'ahead' AS reason FROM f WHERE k < 97 AND ts > TIMESTAMP '2024-01-26 00:00:00'
"""
SQL["stream_window_alarm"] = f"""
WITH {BASE},
beat AS (SELECT eqpid AS eqp_id, date_trunc('hour', ts) AS w, ts FROM f WHERE k < 97)
SELECT eqp_id, {fmt('w')} AS begin_time, {fmt('w + INTERVAL 1 HOUR')} AS end_time, 1 AS status, CAST(count(*) AS INT) AS cnt,
  '2402010000' || replace(eqp_id, '-', '') || '01' || upper(left(md5(eqp_id || '|' || {fmt('w')}), 4)) AS alarm_id
FROM beat WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM beat) GROUP BY eqp_id, w
"""
_classes = [d.title() if i % 2 else d for i, d in enumerate(DEFECTS)] + ["ok"]
_defects = _list(DEFECTS)
DEFECT = f"""
{BASE},
q AS (SELECT *, 'B' || lpad(CAST(user_id % 40 AS VARCHAR), 4, '0') AS boat_id,
        {pick(_classes, 'k')} AS cell_q, {pick(_classes, 'k // 5')} AS col_q,
        22 + CASE WHEN user_id % 3 = 0 THEN 2 ELSE 1 END + CASE WHEN k = 50 THEN 0 ELSE 1 END AS len FROM f WHERE k < 97),
d AS (SELECT seq, ts, puttime AS put_time, boat_id, cell_q, col_q, {", ".join(
    f"CAST(lower(cell_q) = '{d}' AS BIGINT) + CAST(lower(col_q) = '{d}' AS BIGINT) AS h{i}" for i, d in enumerate(DEFECTS))}
  FROM q WHERE len IN (24, 25)
   AND (list_contains({_defects}, lower(cell_q)) OR list_contains({_defects}, lower(col_q))))
"""
SQL["defect_threshold"] = f"""
WITH {DEFECT},
t AS (SELECT *, {", ".join(f"CAST(sum(h{i}) OVER w AS BIGINT) AS {counter_name(d)}" for i, d in enumerate(DEFECTS))}
      FROM d WINDOW w AS (PARTITION BY boat_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING))
SELECT seq, boat_id, cell_q, col_q, put_time, {", ".join(counter_name(d) for d in DEFECTS)} FROM t
WHERE {" OR ".join(f"({counter_name(d)} >= 10 AND {counter_name(d)} - h{i} < 10)" for i, d in enumerate(DEFECTS))}
"""
SQL["stream_defect_counters"] = SQL["defect_threshold"]
# A category starts again two hours after its last write; minutes that the watermark has not passed are open.
_ranks = [(f"h{i}", f"l{i}", f"s{i}", f"r{i}", counter_name(d)) for i, d in enumerate(DEFECTS)]
SQL["stream_defect_counters_ttl"] = f"""
WITH {DEFECT},
a AS (SELECT *, {", ".join(f"max(ts) FILTER (WHERE {h} > 0) OVER w AS {l}" for h, l, _, _, _ in _ranks)} FROM d
      WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM d)
      WINDOW w AS (PARTITION BY boat_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, {", ".join(f"sum(CASE WHEN {l} IS NULL OR ts - {l} >= INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER w AS {s}" for _, l, s, _, _ in _ranks)} FROM a
      WINDOW w AS (PARTITION BY boat_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)),
t AS (SELECT *, {", ".join(
    f"CAST(coalesce(sum({h}) OVER (PARTITION BY boat_id, {s} ORDER BY ts, seq ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS {n}"
    for h, _, s, _, n in _ranks)} FROM b)
SELECT seq, boat_id, cell_q, col_q, put_time, {", ".join(n for *_, n in _ranks)} FROM t
WHERE {" OR ".join(f"({n} >= 3 AND {n} - {h} < 3)" for h, _, _, _, n in _ranks)}
"""
SQL["defect_window_counts"] = f"""
WITH {DEFECT}
SELECT boat_id, {fmt("date_trunc('hour', ts)")} AS window_start, {fmt("date_trunc('hour', ts) + INTERVAL 1 HOUR")} AS window_end,
  {", ".join(f"CAST(sum(h{i}) AS BIGINT) AS {counter_name(d)}" for i, d in enumerate(DEFECTS))}
FROM d GROUP BY boat_id, date_trunc('hour', ts)
"""
SQL["material_id_split"] = f"""
WITH i AS (SELECT p_partkey, {pick(('', 'A', 'AB', 'ABCDEFGHIJKLMNOP'), 'p_partkey')} || 'DF'
     || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || '-3BT' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 4, '0')
     || 'R' || '#Z2' || p_brand AS eq_mtl_id FROM part),
j AS (SELECT *, instr(eq_mtl_id, '-') AS d, CASE WHEN length(eq_mtl_id) = 25 THEN 1 ELSE 0 END AS x FROM i
      WHERE length(eq_mtl_id) IN (24, 25))
SELECT p_partkey, eq_mtl_id, substr(eq_mtl_id, d - 4, 6) AS tube_id, substr(eq_mtl_id, d + 2, 5) AS boat_id,
  substr(eq_mtl_id, d + 7, 1 + x) AS area, replace(substr(eq_mtl_id, d + 8 + x), '#', '') AS site
FROM j WHERE d >= 5 AND d + 7 + x <= length(eq_mtl_id)
"""
_alarm_factory = "CASE left(eqpid, 1) WHEN 'G' THEN '1000' WHEN 'Z' THEN '2000' WHEN 'T' THEN '3000' ELSE 'Other' END"
_mixed = (f"CASE WHEN k = 98 THEN '2024-13-45 00:00:00' WHEN k = 99 THEN ' ' WHEN k % 3 = 0 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') "
          f"WHEN k % 3 = 1 THEN strftime(ts, '%Y%m%d%H%M%S') ELSE puttime END")
_action = f"""eqpid AS machineid, {_mixed} AS occurtime, runcount AS alarmid, 'S' || CAST(k % 4 AS VARCHAR) AS machinestatus,
  'Door open' AS alarmtext, CAST(NULL AS VARCHAR) AS serorclear"""
# A line without an alarm code (k a multiple of 11) is not complete.
SQL["alarm_filter"] = f"""
WITH {BASE} SELECT {_action}, 'Alarm' AS messagetype, CAST(NULL AS VARCHAR) AS updatetime, {_alarm_factory} AS factory
FROM f WHERE k <> 97 AND user_id % 17 <> 0 AND k % 5 <> 0 AND k % 11 > 0
"""
SQL["alarm_tube_match"] = f"""
WITH {BASE},
a AS (SELECT *, 'S' || CAST(k % 4 AS VARCHAR) AS status,
        CASE WHEN eqp_type = 'TA' THEN '' WHEN k % 2 = 0 THEN 'TubeID2' WHEN k % 5 > 0 THEN 'TubeID4' ELSE '' END AS tid FROM v)
SELECT seq, eqpid, status, tid AS tubeid, CAST(NULL AS VARCHAR) AS tubeid2,
  {row_key("(eqpid || '|' || puttime || CASE WHEN tid = '' THEN '' ELSE '|' || tid END)")} AS row_key,
  {shift('ts', 'site')} AS shift FROM a
"""
_furnace = "FROM f WHERE k NOT IN (97, 99) AND k % 11 > 0"
_status = "'S' || CAST(k % 4 AS VARCHAR)"
_parsed = "CASE WHEN k = 98 THEN NULL ELSE puttime END"
SQL["furnace_alarm_history"] = f"""
WITH {BASE} SELECT eqpid AS name, {_status} AS statuscodename, {_status} AS newstatusname, {_status} AS oldstatusname,
  CAST(NULL AS VARCHAR) AS laststatusdate, {_parsed} AS oldstatusdate, CAST(NULL AS VARCHAR) AS usetime,
  CAST(NULL AS VARCHAR) AS updatetime {_furnace}
"""
SQL["furnace_alarm_action"] = f"""
WITH {BASE} SELECT {_action}, 'alarm' AS messagetype, CAST(NULL AS VARCHAR) AS updatetime, {_alarm_factory} AS factory
{_furnace} AND k % 5 <> 0
"""
SQL["furnace_alarm_update"] = f"""
WITH {BASE} SELECT eqpid AS name, {_status} AS statuscodename, {_parsed} AS laststatusdate, 'false' AS prdtimeflag {_furnace}
"""
SQL["status_history"] = f"""
WITH {BASE} SELECT eqpid AS name, event_type AS statuscodename, event_type AS newstatusname, 'IDLE' AS oldstatusname,
  puttime AS laststatusdate, {fmt('ts - INTERVAL 600 SECOND')} AS oldstatusdate, tubeid
FROM f WHERE k NOT IN (96, 97, 98) AND user_id % 17 <> 0
"""
SQL["latest_status"] = f"""
WITH {BASE} SELECT eqpid AS name, event_type AS statuscodename, puttime AS laststatusdate, 'false' AS prdtimeflag FROM (
  SELECT *, row_number() OVER (PARTITION BY eqpid ORDER BY ts DESC, seq DESC) AS n FROM f
  WHERE k NOT IN (96, 97, 98) AND user_id % 17 <> 0) WHERE n = 1
"""

# Sequences ---------------------------------------------------------------------

USERS = """
u AS (SELECT event_id AS seq, ts, user_id, event_type, lead(event_type) OVER w AS e1, lead(ts) OVER w AS t1,
        lead(event_id) OVER w AS s1, lead(event_type, 2) OVER w AS e2, lead(ts, 2) OVER w AS t2, lead(event_id, 2) OVER w AS s2
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
"""
SQL["sequence_match"] = f"""
WITH {USERS} SELECT user_id, seq, s1 AS next_seq FROM u
WHERE event_type = 'view' AND e1 = 'purchase' AND t1 - ts < INTERVAL 6 HOUR
"""
SQL["sequence_timeout"] = f"""
WITH {USERS} SELECT user_id, seq, 'timeout' AS outcome FROM u
WHERE event_type = 'view' AND (t1 IS NULL OR t1 - ts >= INTERVAL 6 HOUR)
"""
SQL["stream_sequences"] = f"""
WITH lim AS (SELECT max(ts) - INTERVAL 1 MINUTE AS mark FROM events),
{USERS.replace("FROM events", "FROM (SELECT * FROM events WHERE ts <= (SELECT mark FROM lim))")},
o AS (SELECT user_id, seq, s1, CASE WHEN t1 IS NULL THEN CASE WHEN mark - ts >= INTERVAL 6 HOUR THEN 'timeout' END
        WHEN t1 - ts >= INTERVAL 6 HOUR THEN 'timeout' WHEN e1 = 'purchase' THEN 'match' END AS outcome
      FROM u, lim WHERE event_type = 'view')
SELECT user_id, seq, outcome, CASE WHEN outcome = 'match' THEN s1 ELSE seq END AS last_seq FROM o WHERE outcome IS NOT NULL
"""
SQL["sequence_three_steps"] = f"""
WITH {USERS},
o AS (SELECT *, CASE WHEN t1 IS NULL THEN NULL WHEN t1 - ts >= INTERVAL 24 HOUR THEN 'timeout'
        WHEN e1 <> 'error' THEN CASE WHEN t2 IS NULL THEN NULL WHEN t2 - ts >= INTERVAL 24 HOUR THEN 'timeout'
          WHEN e2 = 'purchase' THEN 'match' END END AS outcome FROM u WHERE event_type = 'view')
SELECT user_id, seq, outcome,
  CASE WHEN outcome = 'match' THEN 3 WHEN t1 - ts >= INTERVAL 24 HOUR THEN 1 ELSE 2 END AS matched,
  CASE WHEN outcome = 'match' THEN s2 WHEN t1 - ts >= INTERVAL 24 HOUR THEN seq ELSE s1 END AS last_seq
FROM o WHERE outcome IS NOT NULL
"""

def _pair(pattern: str, version: int, first: str, then: str, hours: int, valid: str) -> str:
    return f"""SELECT user_id, seq, '{pattern}' AS pattern_id, {version} AS version,
  CASE WHEN t1 - ts >= INTERVAL {hours} HOUR THEN 'timeout' WHEN e1 = '{then}' THEN 'match' END AS outcome,
  CASE WHEN t1 - ts >= INTERVAL {hours} HOUR THEN 1 ELSE 2 END AS matched,
  CASE WHEN t1 - ts >= INTERVAL {hours} HOUR THEN seq ELSE s1 END AS last_seq FROM u WHERE event_type = '{first}' AND {valid} AND t1 IS NOT NULL"""


SQL["sequence_many_patterns"] = f"""
WITH {USERS},
three AS ({SQL["sequence_three_steps"]}),
o AS ({_pair('buy', 1, 'view', 'purchase', 6, "ts < TIMESTAMP '2024-01-16'")}
      UNION ALL {_pair('buy', 2, 'click', 'purchase', 12, "ts >= TIMESTAMP '2024-01-16'")}
      UNION ALL {_pair('fault', 1, 'error', 'error', 24, "ts >= TIMESTAMP '2024-01-10'")})
SELECT * FROM o WHERE outcome IS NOT NULL
UNION ALL SELECT user_id, seq, 'funnel', 1, outcome, matched, last_seq FROM three
"""

# Nested and wide records ---------------------------------------------------------

MEAS = f"""
m AS (SELECT *, l_orderkey * 10 + l_linenumber AS seq, {fmt('l_shipdate')} AS come,
        'Z2-GP' || lpad(CAST(l_suppkey % 10 AS VARCHAR), 2, '0') AS eqp FROM lineitem)
"""
SQL["measurement_material"] = f"""
WITH {MEAS}
SELECT seq, {row_key("(eqp || '|' || come)")} AS row_key, eqp AS equipmentid, CAST(l_partkey AS VARCHAR) AS imageprocessingtime_ms,
  CAST(l_linenumber AS VARCHAR) AS classificationprocessingtime_ms, 'Evt' AS name, 'M' || CAST(l_partkey AS VARCHAR) AS eqmtlid,
  come, 'T1' AS toolid, l_returnflag AS cls_cellq, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS qty
FROM m WHERE l_linenumber % 4 <> 0 AND l_partkey % 10 > 0
"""
SQL["measurement_state"] = f"""
WITH {MEAS}
SELECT seq, {row_key("(eqp || '|' || come)")} AS row_key, eqp AS equipmentid, eqp AS eqid, l_linestatus AS stateid, come
FROM m WHERE l_linenumber % 4 = 0
"""
_order_codes = ["YP", "PL", "BY", "YZ", "LY", "CFX", "CC", "GSQ", "GSH", "CID"]


def _order_type(text: str) -> str:
    return "(CASE " + " ".join(f"WHEN contains(upper({text}), '{c}') THEN '{c}'" for c in _order_codes) + " ELSE 'NORMAL' END)"


TESTER = f"""
t1 AS (SELECT *, {pick(('G1', 'Z1', 'Z2', 'Z3', 'T1', 'X1'), 'l_orderkey')} AS site,
         CASE WHEN l_linenumber <> 7 THEN strftime(l_shipdate, '%d-%m-%Y') ELSE '' END AS test_date,
         CASE WHEN l_linenumber <> 6 THEN lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':'
           || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') || ':07' ELSE '' END AS test_time,
         CASE l_partkey % 4 WHEN 0 THEN '100' WHEN 1 THEN '0' ELSE CAST(l_partkey % 9 AS VARCHAR) END AS bin,
         'lot ' || {pick(("yp", "PL-BY", "by", "xYZ", "LY", "cfx", "cc", "GSQ", "gsh", "CID", "none"), 'l_partkey')} AS comments
       FROM lineitem),
t2 AS (SELECT *, site || '-CT' || lpad(CAST(l_partkey % 30 AS VARCHAR), 2, '0') AS eqp_id,
         CASE WHEN test_date = '' THEN '1970-01-01' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS begin_date,
         CASE WHEN test_time = '' THEN '00:00:00' ELSE test_time END AS clock FROM t1),
t AS (SELECT *, begin_date || ' ' || clock AS begin_time, CAST(begin_date || ' ' || clock AS TIMESTAMP) AS moment FROM t2)
"""
_tester_key = row_key("(eqp_id || '|' || begin_time)")
_tester_cells = {
    tester_column(k): f"CASE WHEN (l_orderkey + {i}) % 5 > 0 THEN CAST((l_partkey + {i}) % 97 AS VARCHAR) ELSE '' END"
    for i, k in enumerate(TESTER_KEYS)} | {
    "eqp_id": "eqp_id", "testdate": "test_date", "testtime": "test_time", "bin": "bin", "comments": "comments",
    "uniqueid": "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
    "batchid": "CAST(l_orderkey % 1000 AS VARCHAR)", "uoc": "CAST(CAST(l_quantity AS INT) AS VARCHAR)",
    "el2data": "l_linestatus", "irev2": "l_returnflag", "site": "site", "begin_date": "begin_date", "begin_time": "begin_time",
    "shift": f"coalesce({shift('moment', 'site')}, '')", "order_type": _order_type("comments"),
    "bin_type": "CASE WHEN bin IN ('0', '100') THEN bin ELSE 'OTHER' END", "factory": tester_factory("site")}
SQL["tester_wide"] = f"""
WITH {TESTER}
SELECT {_tester_key} AS row_key, {", ".join(f"{e} AS {c}" for c, e in _tester_cells.items() if c not in NOT_IN_FULL)} FROM t
"""
SQL["tester_detail"] = f"""
WITH {TESTER}
SELECT {_tester_key} AS row_key, {", ".join(f"{_tester_cells[c]} AS {n}" for n, c in TESTER_DETAIL.items())} FROM t
"""
SQL["order_type_codes"] = f"""
WITH c AS (SELECT {_order_type("p_name || ' ' || " + pick(("", "by", "gsh", "cc", "LYcid", "yz"), 'p_partkey'))} AS order_type,
  CASE WHEN p_size IN (0, 100) THEN CAST(p_size AS VARCHAR) ELSE 'OTHER' END AS bin_type,
  {tester_factory(pick(("G1", "Z1", "Z2", "Z3", "T1", "X1"), 'p_partkey'))} AS factory FROM part)
SELECT order_type, bin_type, factory, count(*) AS n FROM c GROUP BY order_type, bin_type, factory
"""

# Change events and keyed tables ----------------------------------------------------

CHANGES = f"c AS (SELECT *, CAST(o_custkey AS VARCHAR) AS id, {pick(('r', 'c', 'u', 'u', 'd'), 'o_orderkey')} AS op FROM orders)"
_fields = "unnest(['id', 'status', 'priority']) AS field, unnest([id, {status}, o_orderpriority]) AS field_value"
SQL["cdc_unpack"] = f"""
WITH {CHANGES}
SELECT o_orderkey AS seq, CASE WHEN op = 'u' THEN 'UPDATE' ELSE 'CREATE' END AS change, 'after' AS side,
  {_fields.format(status='o_orderstatus')} FROM c WHERE op <> 'd'
UNION ALL
SELECT o_orderkey, CASE WHEN op = 'u' THEN 'UPDATE' ELSE 'DELETE' END, 'before', {_fields.format(status="'old'")}
FROM c WHERE op IN ('u', 'd')
"""
SQL["cdc_latest"] = f"""
WITH {CHANGES}
SELECT id, o_orderstatus AS status, o_orderpriority AS priority FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM c)
WHERE n = 1 AND op <> 'd'
"""
_cell_key = f"{device('user_id')} || '|' || {tube('user_id')}"


def _last(kind: str, where: str = "TRUE") -> str:
    return f"CAST(arg_max(event_id, ts) FILTER (WHERE event_type = '{kind}' AND {where}) AS VARCHAR) AS {kind}"


SQL["sparse_upsert"] = f"""
SELECT {_cell_key} AS row_key, {_last('view')}, {_last('click')}, {_last('purchase')} FROM events GROUP BY 1
"""
SQL["keyed_merge"] = f"""
SELECT {_cell_key} AS row_key, {_last('view')}, {_last('click', "ts < TIMESTAMP '2024-01-16 00:00:00'")}, {_last('purchase')}
FROM events GROUP BY 1
"""
SQL["delete_by_key"] = f"""
SELECT row_key, view FROM (SELECT {_cell_key} AS row_key, {_last('view')} FROM events GROUP BY 1)
WHERE row_key NOT IN (SELECT {_cell_key} FROM events WHERE event_type = 'error' AND value > 60)
"""

# SQL scripts -------------------------------------------------------------------------

SQL["sql_filter"] = f"""
WITH {BASE} SELECT seq, eqpid, {_puttime} AS puttime, event_type AS status FROM f WHERE k <> 97 AND event_type = 'purchase'
"""
SQL["sql_cast"] = f"""
WITH {BASE} SELECT seq, eqpid, CASE WHEN k % 11 > 0 THEN k END AS cnt FROM f WHERE k <> 97 AND k % 4 = 0
"""

# Streams that equal their batch twins ----------------------------------------------------

SQL["stream_silence_alarm"] = SQL["silence_alarm"]
SQL["stream_cdc_apply"] = SQL["cdc_latest"]
SQL["stream_latest_status"] = SQL["latest_status"]
SQL["stream_sql_filter"] = SQL["sql_filter"]
SQL["stream_topics"] = "SELECT event_type AS topic, event_id, user_id, value FROM events WHERE event_type IN ('view', 'click', 'purchase')"
SQL["stream_fan_out"] = f"""
SELECT 'loaded' AS target, seq, row_key AS detail FROM ({SQL["enrich_standard"]})
UNION ALL SELECT 'rejected', seq, reason FROM ({SQL["rejected_lines"]})
"""
SQL["stream_late_rows"] = """
SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS eqpid, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'late' ELSE 'ahead' END AS reason,
  CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS batch
FROM events WHERE ts < TIMESTAMP '2024-01-16' OR ts > TIMESTAMP '2024-01-26'
"""
SQL["step_rules_table"] = SQL["step_intervals"]
SQL["script_insert"] = f"""
WITH {BASE}, a AS (SELECT seq, eqpid, CASE WHEN k % 11 > 0 THEN k END AS code, 'S' || CAST(k % 4 AS VARCHAR) AS status FROM f WHERE k <> 97)
SELECT eqpid, status, count(*) FILTER (WHERE code >= 50) AS n, max(seq) AS last_seq FROM a GROUP BY eqpid, status HAVING n > 0
"""
SQL["csv_scan"] = """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderstatus AS status,
             CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority || ', it''s "so"' END AS note FROM orders)
SELECT orderkey, status, note, count(note) OVER (PARTITION BY status) AS n FROM o
"""
