"""The registered queries as SQL for an independent engine.

Each text is written from the definition of its table, over the complete star
view, and shares nothing with the DataFrame code but column names.
"""

from __future__ import annotations

FLIGHTS = """
WITH star AS (
  SELECT l.*, p.p_brand, p.p_size, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment,
         sn.n_name AS origin_nation, r.r_name AS origin_region, cn.n_name AS dest_nation,
         CAST(l.l_shipdate AS DATE) AS d,
         (l.l_returnflag = 'R' AND o.o_orderstatus = 'F') AS x
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region r ON sn.n_regionkey = r.r_regionkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
), measured AS (
  SELECT *,
         CASE WHEN NOT x THEN l_quantity - 20 END AS dep,
         CASE WHEN NOT x THEN l_quantity - 20 + l_linenumber - 3 END AS arr
  FROM star
), flights AS (
  SELECT d AS "FL_DATE",
         CAST(year(d) AS INTEGER) AS "YEAR", CAST(month(d) AS INTEGER) AS "MONTH",
         CAST(day(d) AS INTEGER) AS "DAYOFMONTH", CAST(dayofweek(d) + 1 AS INTEGER) AS "DAYOFWEEK",
         p_brand AS "OP_CARRIER", p_brand AS "Reporting_Airline",
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "OP_CARRIER_FL_NUM",
         origin_nation AS "ORIGIN", dest_nation AS "DEST",
         origin_nation || ', ' || origin_region AS "OriginCityName",
         dest_nation || ', ' || c_mktsegment AS "DestCityName",
         lpad(CAST(l_linenumber + 5 AS VARCHAR), 2, '0')
           || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS "CRSDepTime",
         CAST(x AS INTEGER) AS "CANCELLED",
         CAST(l_returnflag = 'N' AND l_linestatus = 'F' AND o_orderstatus = 'P' AS INTEGER) AS "DIVERTED",
         CASE WHEN x THEN substr(o_orderpriority, 1, 1) ELSE '' END AS "CANCELLATION_CODE",
         dep AS "DEP_DELAY", arr AS "ARR_DELAY",
         CASE WHEN dep < 0 THEN 0.0 ELSE dep END AS "DepDelayMinutes",
         CASE WHEN arr < 0 THEN 0.0 ELSE arr END AS "ArrDelayMinutes",
         CAST(arr > 0 AS INTEGER) AS "IS_DELAY",
         CAST(p_size * 50 AS DOUBLE) AS "DISTANCE",
         'State of ' || origin_nation AS "OriginStateName",
         dest_nation || ' ' || lower(c_mktsegment) AS "DestStateName",
         lpad(CAST(l_linenumber + 6 AS VARCHAR), 2, '0') || '15' AS "DepTime",
         CAST(dep >= 15 AS DOUBLE) AS "DepDel15",
         round(l_tax * 100) + 5 AS "TAXI_OUT",
         lpad(CAST(l_linenumber + 6 AS VARCHAR), 2, '0') || '25' AS "WheelsOff",
         lpad(CAST(l_linenumber + 8 AS VARCHAR), 2, '0') || '35' AS "WheelsOn",
         round(l_discount * 100) + 2 AS "TAXI_IN",
         lpad(CAST(l_linenumber + 9 AS VARCHAR), 2, '0') || '45' AS "CRSArrTime",
         lpad(CAST(l_linenumber + 10 AS VARCHAR), 2, '0') || '55' AS "ArrTime",
         CAST(arr >= 15 AS DOUBLE) AS "ArrDel15",
         CAST(p_size * 3 + 40 AS DOUBLE) AS "CRSElapsedTime",
         CAST(p_size * 3 + 40 + l_linenumber AS DOUBLE) AS "ACTUAL_ELAPSED_TIME",
         CAST(p_size * 3 AS DOUBLE) AS "AIR_TIME",
         CAST(l_linenumber * 2 AS DOUBLE) AS "CARRIER_DELAY",
         CAST(length(o_orderpriority) AS DOUBLE) AS "WEATHER_DELAY",
         CAST(year(d) - 1990 AS DOUBLE) AS "NAS_DELAY",
         CAST(length(origin_nation) AS DOUBLE) + 0.5 AS "SECURITY_DELAY",
         CAST(length(dest_nation) AS DOUBLE) + 0.25 AS "LATE_AIRCRAFT_DELAY"
  FROM measured
)
"""

ENTITY_KEYS = {"carrier": '"OP_CARRIER"', "src_dest": '"ORIGIN", "DEST"'}
PERIOD_KEYS = {"total": "", "year": ', "YEAR"', "year_month": ', "YEAR", "MONTH"', "dayofweek": ', "DAYOFWEEK"'}

DELAY = FLIGHTS + """
SELECT {keys}, avg("DEP_DELAY") AS "AVG_DEP_DELAY", avg("ARR_DELAY") AS "AVG_ARR_DELAY"
FROM flights GROUP BY {keys}
"""

CANC_DIV = FLIGHTS + """
SELECT {keys},
       CAST("CANC_COUNT" AS DOUBLE) / CAST("TOTAL_FLIGHTS" AS DOUBLE) * 100.0::DOUBLE AS "CANC_PERC", "CANC_COUNT",
       CAST("DIV_COUNT" AS DOUBLE) / CAST("TOTAL_FLIGHTS" AS DOUBLE) * 100.0::DOUBLE AS "DIV_PERC", "DIV_COUNT",
       "TOTAL_FLIGHTS"
FROM (
  SELECT {keys}, count(*) FILTER (WHERE "CANCELLED" = 1) AS "CANC_COUNT",
         count(*) FILTER (WHERE "DIVERTED" = 1) AS "DIV_COUNT", count(*) AS "TOTAL_FLIGHTS"
  FROM flights GROUP BY {keys}
)
"""

DIST = FLIGHTS + """
SELECT {keys}, sum("DISTANCE") AS "TOTAL_DISTANCE" FROM flights WHERE "DISTANCE" IS NOT NULL GROUP BY {keys}
"""

# A run starts where the day before is not among the delayed days.
STREAK = FLIGHTS + """
, delayed AS (
  SELECT {keys}, "YEAR", "FL_DATE" FROM flights WHERE "ARR_DELAY" IS NOT NULL
  GROUP BY {keys}, "YEAR", "FL_DATE" HAVING avg("ARR_DELAY") > 0
), starts AS (
  SELECT *, CASE WHEN lag("FL_DATE") OVER (PARTITION BY {keys}, "YEAR" ORDER BY "FL_DATE") = "FL_DATE" - 1
            THEN 0 ELSE 1 END AS s FROM delayed
), runs AS (
  SELECT *, sum(s) OVER (PARTITION BY {keys}, "YEAR" ORDER BY "FL_DATE") AS run FROM starts
), lengths AS (
  SELECT {keys}, "YEAR", run, count(*) AS n FROM runs GROUP BY {keys}, "YEAR", run
)
SELECT {keys}, "YEAR", CAST(max(n) AS INTEGER) AS "MAX_CONSEC_DELAY_DAYS" FROM lengths GROUP BY {keys}, "YEAR"
"""

REASONS = FLIGHTS + """
SELECT "ORIGIN", "DEST", "YEAR", "CANCELLATION_CODE", count("CANCELLED") AS "NUM_CANCELLED"
FROM flights WHERE "CANCELLED" = 1 AND "CANCELLATION_CODE" IS NOT NULL AND "CANCELLATION_CODE" <> ''
GROUP BY ALL
"""

SUMMARY = FLIGHTS + """
SELECT "Reporting_Airline", "OriginCityName", "DestCityName",
       avg("ArrDelayMinutes") AS avg_arrival_delay, avg("DepDelayMinutes") AS avg_departure_delay,
       count(*) AS total_flights,
       "Reporting_Airline" || '-' || "OriginCityName" || '-' || "DestCityName" AS id
FROM flights WHERE "Reporting_Airline" IS NOT NULL
GROUP BY "Reporting_Airline", "OriginCityName", "DestCityName"
"""

TOP = FLIGHTS + """
SELECT "DestCityName" AS city, count(*) AS "count" FROM flights WHERE "DestCityName" IS NOT NULL
GROUP BY "DestCityName" ORDER BY count(*) DESC, "DestCityName" LIMIT 100
"""

SETS = """GROUPING SETS (
  ("OP_CARRIER"), ("OP_CARRIER", "YEAR"), ("OP_CARRIER", "YEAR", "MONTH"), ("OP_CARRIER", "DAYOFWEEK"),
  ("ORIGIN", "DEST"), ("ORIGIN", "DEST", "YEAR"), ("ORIGIN", "DEST", "YEAR", "MONTH"),
  ("ORIGIN", "DEST", "DAYOFWEEK"))"""

ALL_GRAINS = FLIGHTS + f"""
SELECT CASE WHEN GROUPING("OP_CARRIER") = 0 THEN 'carrier' ELSE 'src_dest' END
         || CASE WHEN GROUPING("MONTH") = 0 THEN '_year_month' WHEN GROUPING("YEAR") = 0 THEN '_year'
                 WHEN GROUPING("DAYOFWEEK") = 0 THEN '_dayofweek' ELSE '_total' END AS "GRAIN",
       "OP_CARRIER", "YEAR", "MONTH", "DAYOFWEEK", "ORIGIN", "DEST",
       avg("DEP_DELAY") AS "AVG_DEP_DELAY", avg("ARR_DELAY") AS "AVG_ARR_DELAY",
       count(*) FILTER (WHERE "CANCELLED" = 1) AS "CANC_COUNT",
       count(*) FILTER (WHERE "DIVERTED" = 1) AS "DIV_COUNT",
       count(*) AS "TOTAL_FLIGHTS", sum("DISTANCE") AS "TOTAL_DISTANCE"
FROM flights GROUP BY {SETS}
"""

PARTIALS = FLIGHTS + """
SELECT CASE WHEN GROUPING("OP_CARRIER") = 0 THEN 'carrier' ELSE 'src_dest' END AS "GRAIN",
       "OP_CARRIER", "YEAR", "MONTH", "DAYOFWEEK", "FL_DATE", "ORIGIN", "DEST", "CANCELLATION_CODE",
       count(*) AS "N_ROWS",
       sum("DEP_DELAY") AS "DEP_DELAY_SUM", count("DEP_DELAY") AS "DEP_DELAY_N",
       sum("ARR_DELAY") AS "ARR_DELAY_SUM", count("ARR_DELAY") AS "ARR_DELAY_N",
       sum("DISTANCE") AS "DISTANCE_SUM", count("DISTANCE") AS "DISTANCE_N",
       count(*) FILTER (WHERE "CANCELLED" = 1) AS "CANC_COUNT",
       count(*) FILTER (WHERE "DIVERTED" = 1) AS "DIV_COUNT"
FROM flights GROUP BY GROUPING SETS (
  ("OP_CARRIER", "YEAR", "MONTH", "DAYOFWEEK", "FL_DATE"),
  ("ORIGIN", "DEST", "YEAR", "MONTH", "DAYOFWEEK", "FL_DATE", "CANCELLATION_CODE"))
"""

# The published types: delays, minutes and distance are 32 bit; blank text fields read as NULL from text files.
PUBLISHED = FLIGHTS + """
SELECT DISTINCT
       "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "OriginCityName", "OriginStateName", "DEST",
       "DestCityName", "DestStateName", "CRSDepTime", "DepTime", CAST("DEP_DELAY" AS FLOAT) AS "DEP_DELAY",
       CAST("DepDelayMinutes" AS FLOAT) AS "DepDelayMinutes", CAST("DepDel15" AS FLOAT) AS "DepDel15",
       CAST("TAXI_OUT" AS FLOAT) AS "TAXI_OUT", "WheelsOff", "WheelsOn", CAST("TAXI_IN" AS FLOAT) AS "TAXI_IN",
       "CRSArrTime", "ArrTime", CAST("ARR_DELAY" AS FLOAT) AS "ARR_DELAY",
       CAST("ArrDelayMinutes" AS FLOAT) AS "ArrDelayMinutes", CAST("ArrDel15" AS FLOAT) AS "ArrDel15", "CANCELLED",
       {code} AS "CANCELLATION_CODE", "DIVERTED", CAST("CRSElapsedTime" AS FLOAT) AS "CRSElapsedTime",
       CAST("ACTUAL_ELAPSED_TIME" AS FLOAT) AS "ACTUAL_ELAPSED_TIME", CAST("AIR_TIME" AS FLOAT) AS "AIR_TIME",
       CAST("DISTANCE" AS FLOAT) AS "DISTANCE", CAST("CARRIER_DELAY" AS FLOAT) AS "CARRIER_DELAY",
       CAST("WEATHER_DELAY" AS FLOAT) AS "WEATHER_DELAY", CAST("NAS_DELAY" AS FLOAT) AS "NAS_DELAY",
       CAST("SECURITY_DELAY" AS FLOAT) AS "SECURITY_DELAY",
       CAST("LATE_AIRCRAFT_DELAY" AS FLOAT) AS "LATE_AIRCRAFT_DELAY", "YEAR", "MONTH", "DAYOFMONTH", "DAYOFWEEK",
       "IS_DELAY"
FROM flights
"""
CODE = '"CANCELLATION_CODE"'
CODE_FROM_TEXT = "nullif(\"CANCELLATION_CODE\", '')"

CALENDAR = FLIGHTS + 'SELECT DISTINCT "FL_DATE", "YEAR", "MONTH", "DAYOFMONTH", "DAYOFWEEK" FROM flights'

DELAY_FLAG = FLIGHTS + 'SELECT "ARR_DELAY", "IS_DELAY", count(*) AS n FROM flights GROUP BY ALL'

DEDUP = FLIGHTS + """
, doubled AS (SELECT * FROM flights UNION ALL SELECT * FROM flights)
SELECT DISTINCT "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "OriginCityName", "DEST", "DestCityName",
       "DEP_DELAY", "DepDelayMinutes", "ARR_DELAY", "ArrDelayMinutes", "CANCELLED", "CANCELLATION_CODE", "DIVERTED",
       "DISTANCE", "YEAR", "MONTH", "DAYOFMONTH", "DAYOFWEEK", "IS_DELAY"
FROM doubled
"""

REQUIRED = FLIGHTS + """
SELECT "OP_CARRIER", "ORIGIN", count(*) AS n FROM flights
WHERE "ARR_DELAY" IS NOT NULL AND "DISTANCE" IS NOT NULL AND "OP_CARRIER" IS NOT NULL
  AND "ORIGIN" IS NOT NULL AND "DEST" IS NOT NULL
GROUP BY ALL
"""

# One file at most for each month and task, so files are summed up by folder; the empty file stays.
MANIFEST = """
SELECT 'month=' || CAST(month(l_shipdate) AS VARCHAR) AS folder, count(*) AS row_count, FALSE AS empty
FROM lineitem GROUP BY ALL
UNION ALL SELECT 'empty', 0, TRUE
"""

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

DEFAULTS = FLIGHTS + """
SELECT "ORIGIN" AS "Origin", "DEST" AS "Dest", CAST("CANCELLED" AS DOUBLE) AS "Cancelled", count(*) AS n,
       sum(coalesce("DEP_DELAY", 0.0)) AS dep_delay, sum(coalesce("ARR_DELAY", 0.0)) AS arr_delay,
       sum("CARRIER_DELAY") AS carrier_delay, sum("DISTANCE") AS distance, count("TAXI_OUT") AS n_taxi_out,
       min(CAST("CRSDepTime" AS INTEGER)) AS first_clock
FROM flights GROUP BY ALL
"""

WIRE_FLIGHTS = FLIGHTS + """
SELECT "ORIGIN" AS "Origin", "DestCityName", "CANCELLATION_CODE" AS "CancellationCode", count("ARR_DELAY") AS n_arr_delay,
       sum("ARR_DELAY") AS arr_delay, sum("DISTANCE") AS distance, count("TAXI_OUT") AS n_taxi_out
FROM flights GROUP BY ALL
"""

RAW_APPEND = """
SELECT event_id, ts, user_id, event_type, value, props, CAST(64 AS INTEGER) AS id_length, TRUE AS id_is_digest FROM events
"""

RUNNING = "SELECT event_type, count(*) AS recent_flight_count, event_type AS id FROM events GROUP BY event_type"

TUMBLING = """
SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY ALL
"""

# The watermark ends one hour before the newest event; windows that end by then have been emitted.
LATE = f"""
SELECT * FROM ({TUMBLING}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""

SPEED = FLIGHTS + """
SELECT "OriginCityName", count(*) AS recent_flight_count, "OriginCityName" AS id FROM flights GROUP BY "OriginCityName"
"""

MINUTES = FLIGHTS + """
SELECT CAST("FL_DATE" AS TIMESTAMP) + to_minutes(60 * CAST(substr("CRSDepTime", 1, 2) AS INTEGER)
         + CAST(substr("CRSDepTime", 3, 2) AS INTEGER)) AS window_start,
       "OriginCityName", count(*) AS n
FROM flights GROUP BY ALL
"""

LATEST = """
SELECT user_id, last.event_id AS event_id, last.ts AS ts, last.event_type AS event_type,
       last.value AS value, last.props AS props
FROM (SELECT user_id, arg_max(events, {'ts': ts, 'event_id': event_id}) AS last FROM events GROUP BY user_id)
"""

BUCKET = """
CAST('0x' || substr(md5('["{salt}","' || CAST("FL_DATE" AS VARCHAR) || '","' || "OP_CARRIER_FL_NUM" || '","'
  || "OP_CARRIER" || '","' || "ORIGIN" || '","' || "DEST" || '"]'), 1, 8) AS BIGINT)
"""

SAMPLE = FLIGHTS + f"""
SELECT "FL_DATE", "OP_CARRIER_FL_NUM", "OP_CARRIER", "ORIGIN", "DEST", "DISTANCE"
FROM flights WHERE {BUCKET.format(salt="sample")} < 858993459
"""

SPLIT = FLIGHTS + f"""
SELECT CASE WHEN {BUCKET.format(salt="split")} < 3435973837 THEN 'train' ELSE 'test' END AS "PART", "OP_CARRIER", count(*) AS n
FROM flights GROUP BY ALL
"""

CLASSES = FLIGHTS + """
SELECT count(*) AS n, count(DISTINCT "CANCELLED") AS cancel_classes, count(DISTINCT "IS_DELAY") AS delay_classes
FROM flights
"""

STRING_INDEX = FLIGHTS + """
SELECT "DestCityName" AS value,
       CAST(row_number() OVER (ORDER BY count(*) DESC, "DestCityName") - 1 AS INTEGER) AS value_index, count(*) AS n
FROM flights GROUP BY "DestCityName"
"""


RULE_METRICS = FLIGHTS + """
, scored AS (SELECT "IS_DELAY" AS y, CAST("DEP_DELAY" > 0 AS INTEGER) AS p FROM flights WHERE "IS_DELAY" IS NOT NULL),
classes AS (
  SELECT k, CAST(count(*) FILTER (WHERE y = k) AS DOUBLE) AS actual,
         CAST(count(*) FILTER (WHERE y = k AND p = k) AS DOUBLE) / count(*) FILTER (WHERE p = k) AS prec,
         CAST(count(*) FILTER (WHERE y = k AND p = k) AS DOUBLE) / count(*) FILTER (WHERE y = k) AS rec
  FROM scored, (VALUES (0), (1)) AS c(k) GROUP BY k
)
SELECT CAST(sum(actual) AS BIGINT) AS test_rows, round(sum(actual * rec) / sum(actual), 9) AS accuracy,
       round(sum(actual * 2 * prec * rec / (prec + rec)) / sum(actual), 9) AS f1
FROM classes
"""


# Parts of the two classifiers' rows by the 32-bit hash of what identifies a flight; the training part is sampled.
PARTS = FLIGHTS + """
, placed AS (
  SELECT "{label}" AS y,
         CAST('0x' || substr(md5('["split","' || CAST("FL_DATE" AS VARCHAR) || '","' || "OP_CARRIER_FL_NUM" || '"]'), 1, 8)
              AS BIGINT) AS s,
         CAST('0x' || substr(md5('["sample","' || CAST("FL_DATE" AS VARCHAR) || '","' || "OP_CARRIER_FL_NUM" || '"]'), 1, 8)
              AS BIGINT) AS t
  FROM flights WHERE "{needed}" IS NOT NULL
)
SELECT '{label}' AS label, count(*) FILTER (WHERE s < 3435973837 AND t < {bound}) AS train_rows,
       count(*) FILTER (WHERE s < 3435973837 AND t < {bound} AND y = 0) AS train_negatives,
       count(*) FILTER (WHERE s < 3435973837 AND t < {bound} AND y = 1) AS train_positives,
       count(*) FILTER (WHERE s >= 3435973837) AS test_rows, count(*) FILTER (WHERE s >= 3435973837) AS measured_rows
FROM placed
"""

# One column parts the classes with a wide margin, so every test row is predicted right.
SEPARABLE = FLIGHTS + """
, placed AS (
  SELECT CAST("DISTANCE" > 1250 AS INTEGER) AS y,
         CAST('0x' || substr(md5('["split","' || CAST("FL_DATE" AS VARCHAR) || '","' || "OP_CARRIER_FL_NUM" || '"]'), 1, 8)
              AS BIGINT) AS s
  FROM flights WHERE "DISTANCE" < 800 OR "DISTANCE" > 1700
)
SELECT y AS label, y AS prediction, count(*) AS n FROM placed WHERE s >= 3435973837 GROUP BY ALL
"""

SCORE_COLUMN = SEPARABLE.replace("count(*) AS n", "count(*) AS n, TRUE AS agrees")

BATCH_ERROR = "SELECT event_type, count(*) AS n, TRUE AS error_seen FROM events GROUP BY event_type"

DOCUMENT_IDS = FLIGHTS + """
SELECT '["' || "ORIGIN" || '","' || "DEST" || '"]' AS id, "ORIGIN", "DEST",
       avg("DEP_DELAY") AS "AVG_DEP_DELAY", avg("ARR_DELAY") AS "AVG_ARR_DELAY"
FROM flights GROUP BY "ORIGIN", "DEST"
"""

COUNTS_ON_WRITE = f"""
SELECT (SELECT count(*) FROM lineitem) AS rows_read, count(*) AS rows_written FROM ({PUBLISHED.format(code='"CANCELLATION_CODE"')})
"""

PREVIEW = FLIGHTS + """
SELECT "OP_CARRIER", "YEAR", "MONTH", avg("DEP_DELAY") AS "AVG_DEP_DELAY", avg("ARR_DELAY") AS "AVG_ARR_DELAY"
FROM flights GROUP BY ALL ORDER BY "OP_CARRIER", "YEAR", "MONTH" LIMIT 20
"""

KEPT = FLIGHTS + 'SELECT "YEAR", count(*) AS n, count(DISTINCT "ORIGIN") AS origins FROM flights GROUP BY "YEAR"'


# The earliest of the longest runs. A run starts where the day before is not among the delayed days.
RUNS = FLIGHTS + """
, delayed AS (
  SELECT {keys}, "FL_DATE" FROM flights WHERE "ARR_DELAY" IS NOT NULL
  GROUP BY {keys}, "FL_DATE" HAVING avg("ARR_DELAY") > 0
), starts AS (
  SELECT *, CASE WHEN lag("FL_DATE") OVER (PARTITION BY {within} ORDER BY "FL_DATE") = "FL_DATE" - 1
            THEN 0 ELSE 1 END AS s FROM delayed
), runs AS (
  SELECT *, sum(s) OVER (PARTITION BY {within} ORDER BY "FL_DATE") AS run FROM starts
), lengths AS (
  SELECT {keys}, run, count(*) AS n, min("FL_DATE") AS first, max("FL_DATE") AS last FROM runs GROUP BY {keys}, run
)
SELECT {keys}, CAST(n AS INTEGER) AS "MAX_CONSEC_DELAY_DAYS", first AS "RUN_START", last AS "RUN_END" FROM lengths
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, first) = 1
"""

PUBLISHES = """
WITH orders_in_cents AS (
  SELECT * EXCLUDE (o_totalprice), CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
), old AS (
  SELECT * FROM orders_in_cents WHERE o_orderkey % 11 <> 0
  UNION ALL SELECT * FROM orders_in_cents WHERE o_orderkey % 13 = 0
), priced AS (
  SELECT * REPLACE (cents + CASE WHEN o_orderkey % 17 = 0 THEN 100 ELSE 0 END AS cents) FROM orders_in_cents WHERE o_orderkey % 7 <> 0
), new AS (
  SELECT * FROM priced UNION ALL SELECT * FROM priced WHERE o_orderkey % 19 = 0
)
"""

CHANGE_FEED = PUBLISHES + """
SELECT *, count(*) AS "CHANGE" FROM (SELECT * FROM new EXCEPT ALL SELECT * FROM old) GROUP BY ALL
UNION ALL
SELECT *, -count(*) FROM (SELECT * FROM old EXCEPT ALL SELECT * FROM new) GROUP BY ALL
"""

REFRESHED = PUBLISHES + """
SELECT o_orderpriority, o_orderstatus, count(*) AS "ROWS", CAST(sum(cents) AS BIGINT) AS "cents_SUM", count(cents) AS "cents_N"
FROM new GROUP BY o_orderpriority, o_orderstatus
"""

ASOF_CLICK = """
WITH clicks AS (SELECT user_id, ts, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY user_id, ts)
SELECT p.event_id, p.user_id, p.ts, c.ts AS click_ts, c.click_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.ts
"""

ASOF_ORDER = """
WITH earlier AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS prev_orderkey FROM orders GROUP BY o_custkey, o_orderdate)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, e.prev_orderkey
FROM orders o ASOF LEFT JOIN earlier e ON o.o_custkey = e.o_custkey AND o.o_orderdate > e.o_orderdate
"""

OPEN_ITEMS = """
WITH items AS (
  SELECT l_returnflag, o_orderdate AS s, l_shipdate AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate
), edges AS (
  SELECT l_returnflag, s AS "MOMENT", 1 AS d FROM items UNION ALL SELECT l_returnflag, e, -1 FROM items
), steps AS (
  SELECT l_returnflag, "MOMENT", sum(d) AS d FROM edges GROUP BY l_returnflag, "MOMENT" HAVING sum(d) <> 0
), opened AS (
  SELECT l_returnflag, "MOMENT", CAST(sum(d) OVER (PARTITION BY l_returnflag ORDER BY "MOMENT") AS BIGINT) AS "OPEN" FROM steps
)
"""

OPEN_PEAK = OPEN_ITEMS + """
SELECT l_returnflag, "OPEN", "MOMENT" FROM opened
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY "OPEN" DESC, "MOMENT") = 1
"""

DISTINCT_SKETCHES = FLIGHTS + f"""
SELECT CASE WHEN GROUPING("OP_CARRIER") = 0 THEN 'carrier' ELSE 'src_dest' END
         || CASE WHEN GROUPING("MONTH") = 0 THEN '_year_month' WHEN GROUPING("YEAR") = 0 THEN '_year'
                 WHEN GROUPING("DAYOFWEEK") = 0 THEN '_dayofweek' ELSE '_total' END AS "GRAIN",
       "OP_CARRIER", "YEAR", "MONTH", "DAYOFWEEK", "ORIGIN", "DEST",
       count(DISTINCT "OP_CARRIER_FL_NUM") AS "OP_CARRIER_FL_NUM_EXACT", count(DISTINCT "FL_DATE") AS "FL_DATE_EXACT",
       TRUE AS "OP_CARRIER_FL_NUM_NEAR", TRUE AS "FL_DATE_NEAR"
FROM flights GROUP BY {SETS}
"""

QUANTILE_SKETCHES = FLIGHTS + """
SELECT "OP_CARRIER", percent, count("ARR_DELAY") AS n, TRUE AS near
FROM flights, (VALUES (10), (50), (90)) AS asked(percent) WHERE "ARR_DELAY" IS NOT NULL GROUP BY "OP_CARRIER", percent
"""

LEGS = """
SELECT l_orderkey, l_linenumber AS "LEG", l_partkey AS "Part", l_quantity AS "Quantity", l_shipdate AS "Ship" FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_quantity DESC, l_shipdate DESC) = 1
"""

ONCE = "SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events"

ONCE_COUNT = """
SELECT event_type, count(*) AS recent_flight_count, event_type AS id
FROM (SELECT DISTINCT * FROM events) GROUP BY event_type
"""

# One early day arrives a second time, after its windows have closed.
WITH_LATE = """
WITH arrived AS (
  SELECT ts, event_type, FALSE AS behind FROM events
  UNION ALL
  SELECT ts, event_type, TRUE FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'
), hours AS (
  SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, behind FROM arrived
)
"""

LATE_KEPT = WITH_LATE + """
SELECT window_start, window_end, event_type, count(*) AS n,
       count(*) FILTER (WHERE NOT behind) AS on_time, count(*) FILTER (WHERE behind) AS late
FROM hours GROUP BY window_start, window_end, event_type
"""

CLOSED_CORRECTED = WITH_LATE + """
SELECT window_start, window_end, event_type, count(*) AS n FROM hours
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY window_start, window_end, event_type
"""

MERGED_LATEST = """
SELECT user_id, count(*) AS n, coalesce(CAST(user_id AS VARCHAR), '(none)') AS id FROM events GROUP BY user_id
"""

MERGED_SUMS = WITH_LATE + """
SELECT window_start, window_end, event_type, count(*) AS n FROM hours GROUP BY window_start, window_end, event_type
"""


def _moments(scaled: bool = False) -> str:
    """Slot moments: of the columns themselves, and of a 0/1 column per category value."""
    plain = [
        f"SELECT '{c}' AS feature, avg(\"{c}\") AS mean, stddev_samp(\"{c}\") AS std FROM flights"
        for c in ("MONTH", "DAYOFMONTH", "DAYOFWEEK", "DISTANCE")
    ]
    categories = [
        f"SELECT 'ONEHOT_{name}_' || \"{c}\", count(*) / t.n, sqrt((count(*) / t.n) * (1 - count(*) / t.n) * t.n / (t.n - 1)) "
        f'FROM flights, (SELECT CAST(count(*) AS DOUBLE) AS n FROM flights) t GROUP BY "{c}", t.n'
        for c, name in (("OP_CARRIER", "CARRIER"), ("ORIGIN", "ORIGIN"), ("DEST", "DEST"))
    ]
    slots = "\nUNION ALL ".join(plain + categories)
    if scaled:  # by the standard deviation; a constant slot becomes 0
        slots = f"SELECT feature, coalesce(mean / nullif(std, 0), 0) AS mean, CAST(std > 0 AS DOUBLE) AS std FROM ({slots})"
    return f"{FLIGHTS} SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM ({slots})"


def oracle_sql() -> dict[str, str]:
    found = {}
    for entity, entity_keys in ENTITY_KEYS.items():
        for period, period_keys in PERIOD_KEYS.items():
            keys = entity_keys + period_keys
            found[f"delay_{period}_{entity}"] = DELAY.format(keys=keys)
            found[f"canc_div_{period}_{entity}"] = CANC_DIV.format(keys=keys)
            if entity == "carrier":
                found[f"dist_{period}_{entity}"] = DIST.format(keys=keys)
        found[f"max_consec_delay_year_{entity}"] = STREAK.format(keys=entity_keys)
    found |= {
        "src_dest_canc_code": REASONS,
        "airline_route_summary": SUMMARY,
        "top_destinations": TOP,
        "grain_rollup_all": ALL_GRAINS,
        "day_partials": PARTIALS,
        "normalise_flights": PUBLISHED.format(code=CODE),
        "calendar_parts": CALENDAR,
        "delay_flag": DELAY_FLAG,
        "dedup_flights": DEDUP,
        "required_fields": REQUIRED,
        "csv_roundtrip": PUBLISHED.format(code=CODE_FROM_TEXT),
        "csv_inferred_summary": SUMMARY,
        "csv_top_destinations": TOP,
        "parquet_roundtrip": PUBLISHED.format(code=CODE_FROM_TEXT),
        "ingest_manifest": MANIFEST,
        "wire_roundtrip": EVENTS,
        "delay_defaults": DEFAULTS,
        "wire_flights": WIRE_FLIGHTS,
        "stream_raw_append": RAW_APPEND,
        "stream_running_count": RUNNING,
        "stream_tumbling_count": TUMBLING,
        "stream_late_drop": LATE,
        "flight_summary_speed": SPEED,
        "stream_origin_minutes": MINUTES,
        "delay_runs_carrier": RUNS.format(keys='"OP_CARRIER"', within='"OP_CARRIER"'),
        "delay_runs_src_dest": RUNS.format(keys='"ORIGIN", "DEST"', within='"ORIGIN", "DEST"'),
        "delay_runs_year_src_dest": RUNS.format(keys='"ORIGIN", "DEST", "YEAR"', within='"ORIGIN", "DEST", "YEAR"'),
        "change_feed": CHANGE_FEED,
        "changes_applied": PUBLISHES + "SELECT * FROM new",
        "refreshed_partials": REFRESHED,
        "asof_click": ASOF_CLICK,
        "asof_previous_order": ASOF_ORDER,
        "open_items": OPEN_ITEMS + 'SELECT l_returnflag, "MOMENT", "OPEN" FROM opened',
        "open_items_peak": OPEN_PEAK,
        "distinct_sketches": DISTINCT_SKETCHES,
        "quantile_sketches": QUANTILE_SKETCHES,
        "legs_roundtrip": LEGS,
        "stream_interval": RUNNING,
        "stream_batch_error": BATCH_ERROR,
        "stream_once": ONCE,
        "stream_once_count": ONCE_COUNT,
        "stream_late_kept": LATE_KEPT,
        "stream_closed_corrected": CLOSED_CORRECTED,
        "merged_latest": MERGED_LATEST,
        "merged_sums": MERGED_SUMS,
        "latest_per_key": LATEST,
        "hash_sample": SAMPLE,
        "hash_split": SPLIT,
        "label_classes": CLASSES,
        "ml_string_index": STRING_INDEX,
        "ml_feature_moments": _moments(),
        "ml_scaled_moments": _moments(scaled=True),
        "ml_rule_metrics": RULE_METRICS,
        "ml_delay_metrics": PARTS.format(label="IS_DELAY", needed="ARR_DELAY", bound=42949673),
        "ml_cancel_metrics": PARTS.format(label="CANCELLED", needed="CANCELLED", bound=858993459),
        "ml_separable": SEPARABLE,
        "ml_score_column": SCORE_COLUMN,
        "sink_document_ids": DOCUMENT_IDS,
        "sink_top_destinations": TOP,
        "counts_on_write": COUNTS_ON_WRITE,
        "sorted_preview": PREVIEW,
        "kept_columns": KEPT,
    }
    return found
