"""The flights table as a view over a star of order tables.

Each line item is one flight: its supplier's nation is the origin, its
customer's nation the destination, its part's brand the carrier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.schemas import PUBLISHED_COLUMNS, RAW_COLUMNS

_CANCELLED = "(l_returnflag = 'R' AND o_orderstatus = 'F')"
_DEPARTURE = f"CASE WHEN NOT {_CANCELLED} THEN l_quantity - 20 END"
_ARRIVAL = f"CASE WHEN NOT {_CANCELLED} THEN l_quantity - 20 + l_linenumber - 3 END"
_DATE = "CAST(l_shipdate AS DATE)"

# Column -> (expression, sides of the star it needs).
COLUMNS: dict[str, tuple[str, set[str]]] = {
    "FL_DATE": (_DATE, set()),
    "YEAR": (f"year({_DATE})", set()),
    "MONTH": (f"month({_DATE})", set()),
    "DAYOFMONTH": (f"dayofmonth({_DATE})", set()),
    "DAYOFWEEK": (f"dayofweek({_DATE})", set()),
    "OP_CARRIER": ("p_brand", {"part"}),
    "Reporting_Airline": ("p_brand", {"part"}),
    "OP_CARRIER_FL_NUM": ("concat_ws('-', l_orderkey, l_linenumber)", set()),
    "ORIGIN": ("origin_nation", {"supplier"}),
    "DEST": ("dest_nation", {"orders", "customer"}),
    "OriginCityName": ("concat_ws(', ', origin_nation, origin_region)", {"supplier", "region"}),
    "DestCityName": ("concat_ws(', ', dest_nation, c_mktsegment)", {"orders", "customer"}),
    "CRSDepTime": ("lpad(string(l_linenumber + 5), 2, '0') || lpad(string(int(l_quantity)), 2, '0')", set()),
    "CANCELLED": (f"int({_CANCELLED})", {"orders"}),
    "DIVERTED": ("int(l_returnflag = 'N' AND l_linestatus = 'F' AND o_orderstatus = 'P')", {"orders"}),
    "CANCELLATION_CODE": (f"CASE WHEN {_CANCELLED} THEN substring(o_orderpriority, 1, 1) ELSE '' END", {"orders"}),
    "DEP_DELAY": (_DEPARTURE, {"orders"}),
    "ARR_DELAY": (_ARRIVAL, {"orders"}),
    "DepDelayMinutes": (f"CASE WHEN {_DEPARTURE} < 0 THEN 0D ELSE {_DEPARTURE} END", {"orders"}),
    "ArrDelayMinutes": (f"CASE WHEN {_ARRIVAL} < 0 THEN 0D ELSE {_ARRIVAL} END", {"orders"}),
    "IS_DELAY": (f"int({_ARRIVAL} > 0)", {"orders"}),
    "DISTANCE": ("double(p_size * 50)", {"part"}),
    # Stand-ins for what an order has no equal of; no two columns agree, so a swapped pair shows.
    "OriginStateName": ("concat_ws(' ', 'State of', origin_nation)", {"supplier"}),
    "DestStateName": ("concat_ws(' ', dest_nation, lower(c_mktsegment))", {"orders", "customer"}),
    "DepTime": ("lpad(string(l_linenumber + 6), 2, '0') || '15'", set()),
    "DepDel15": (f"double({_DEPARTURE} >= 15)", {"orders"}),
    "TAXI_OUT": ("round(l_tax * 100) + 5", set()),
    "WheelsOff": ("lpad(string(l_linenumber + 6), 2, '0') || '25'", set()),
    "WheelsOn": ("lpad(string(l_linenumber + 8), 2, '0') || '35'", set()),
    "TAXI_IN": ("round(l_discount * 100) + 2", set()),
    "CRSArrTime": ("lpad(string(l_linenumber + 9), 2, '0') || '45'", set()),
    "ArrTime": ("lpad(string(l_linenumber + 10), 2, '0') || '55'", set()),
    "ArrDel15": (f"double({_ARRIVAL} >= 15)", {"orders"}),
    "CRSElapsedTime": ("double(p_size * 3 + 40)", {"part"}),
    "ACTUAL_ELAPSED_TIME": ("double(p_size * 3 + 40 + l_linenumber)", {"part"}),
    "AIR_TIME": ("double(p_size * 3)", {"part"}),
    "CARRIER_DELAY": ("double(l_linenumber * 2)", set()),
    "WEATHER_DELAY": ("double(length(o_orderpriority))", {"orders"}),
    "NAS_DELAY": (f"double(year({_DATE}) - 1990)", set()),
    "SECURITY_DELAY": ("length(origin_nation) + 0.5D", {"supplier"}),
    "LATE_AIRCRAFT_DELAY": ("length(dest_nation) + 0.25D", {"orders", "customer"}),
}

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns, joining only the tables they come from.

    Every foreign key of a line item has its row (the tests check it), so a
    table that supplies no column is left out without changing the rows.
    No side is marked for broadcast. Base tables join one at a time, so
    Spark compares each file's own size with its threshold, and large sides
    take the sort-merge join with skew splitting. A join's size is estimated as
    the product of its sides: suppliers joined with their nations first would
    count as large and move the line items by supplier. Orders meet their
    customers before the line items, which are then not moved by customer.
    """
    wanted = columns or tuple(COLUMNS)
    sides = set().union(*[COLUMNS[c][1] for c in wanted])
    rows = _table(spark, sf_dir, "lineitem")
    nation = _table(spark, sf_dir, "nation")
    if "part" in sides:
        rows = rows.join(_table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "supplier" in sides:
        origin = nation.select(
            F.col("n_nationkey").alias("origin_key"),
            F.col("n_name").alias("origin_nation"),
            F.col("n_regionkey").alias("origin_regionkey"),
        )
        rows = rows.join(_table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        rows = rows.join(origin, F.col("s_nationkey") == F.col("origin_key"))
        if "region" in sides:
            region = _table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("origin_region"))
            rows = rows.join(region, F.col("origin_regionkey") == F.col("r_regionkey"))
    if "orders" in sides:
        orders = _table(spark, sf_dir, "orders")
        if "customer" in sides:
            dest = nation.select(F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("dest_nation"))
            orders = orders.join(_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            orders = orders.join(dest, F.col("c_nationkey") == F.col("dest_key"))
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.selectExpr(*[f"{COLUMNS[c][0]} AS {c}" for c in wanted])


def raw_flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The view written the way raw files are: text only, numbers with two decimals, NULL elsewhere.

    With ``columns``, these only. Numbers are written as one array;
    ``transform`` keeps the projection out of whole-stage code, where it would
    be one method too long for HotSpot to compile.
    """
    wanted = columns or tuple(RAW_COLUMNS)
    numbers = {raw: name for raw, name, kind in PUBLISHED_COLUMNS if kind == "float"}
    numbers = {raw: name for raw, name in (numbers | {"Cancelled": "CANCELLED", "Diverted": "DIVERTED"}).items() if raw in wanted}
    texts = {raw: name for raw, name, kind in PUBLISHED_COLUMNS if kind == "text"} | {
        "Year": "string(YEAR)",
        "Month": "string(MONTH)",
        "DayofMonth": "string(DAYOFMONTH)",
        "FlightDate": "date_format(FL_DATE, 'yyyy-MM-dd')",
        "Reporting_Airline": "OP_CARRIER",
    }
    doubles = ", ".join(f"double({name})" for name in numbers.values())
    decimals = [f"transform(array({doubles}), x -> string(CAST(x AS DECIMAL(10, 2)))) AS decimals"] if numbers else []
    rows = flights(spark, sf_dir).selectExpr(*[f"{texts[c]} AS {c}" for c in wanted if c in texts], *decimals)
    place = {raw: f"decimals[{i}]" for i, raw in enumerate(numbers)}
    return rows.selectExpr(*[f"{c if c in texts else place.get(c, 'string(NULL)')} AS {c}" for c in wanted])
