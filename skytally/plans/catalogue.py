"""The result tables as data, and two ways to compute them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.operators import rollups
from skytally.operators.ranking import ordered
from skytally.operators.streaks import longest_delay_run, longest_run

MEANS = {"AVG_DEP_DELAY": "DEP_DELAY", "AVG_ARR_DELAY": "ARR_DELAY"}
DISTANCE = {"TOTAL_DISTANCE": "DISTANCE"}
REASON_KEYS = ["ORIGIN", "DEST", "YEAR", "CANCELLATION_CODE"]

ENTITIES = {"carrier": ["OP_CARRIER"], "src_dest": ["ORIGIN", "DEST"]}
PERIODS = {"total": [], "year": ["YEAR"], "year_month": ["YEAR", "MONTH"], "dayofweek": ["DAYOFWEEK"]}
# One day per entity is the finest grain that the tables need.
CALENDAR = ["YEAR", "MONTH", "DAYOFWEEK", "FL_DATE"]
DAY_GRAINS = {
    "carrier": [*ENTITIES["carrier"], *CALENDAR],
    "src_dest": [*ENTITIES["src_dest"], *CALENDAR, "CANCELLATION_CODE"],
}


def events() -> dict[str, Column]:
    return {"CANC": F.col("CANCELLED") == 1, "DIV": F.col("DIVERTED") == 1}


@dataclass(frozen=True)
class ResultTable:
    family: str
    entity: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()
    id_columns: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        """Input columns: all that a scan has to read."""
        measures = {
            "delay": list(MEANS.values()),
            "canc_div": ["CANCELLED", "DIVERTED"],
            "dist": list(DISTANCE.values()),
            "max_consec_delay": ["FL_DATE", "ARR_DELAY"],
            "canc_code": ["CANCELLED"],
        }
        return list(dict.fromkeys([*self.keys, *measures[self.family]]))


def _tables() -> dict[str, ResultTable]:
    tables = {}
    for family in ("delay", "canc_div", "dist"):
        for entity, entity_keys in ENTITIES.items():
            if (family, entity) == ("dist", "src_dest"):
                continue
            for period, period_keys in PERIODS.items():
                order = () if family == "delay" else (*period_keys, *entity_keys)
                # A single key serves as document id.
                alone = len(entity_keys + period_keys) == 1
                tables[f"{family}_{period}_{entity}"] = ResultTable(
                    family, entity, (*entity_keys, *period_keys), order, tuple(entity_keys) if alone else ()
                )
    for entity, entity_keys in ENTITIES.items():
        tables[f"max_consec_delay_year_{entity}"] = ResultTable("max_consec_delay", entity, (*entity_keys, "YEAR"))
    tables["src_dest_canc_code"] = ResultTable("canc_code", "src_dest", tuple(REASON_KEYS))
    return tables


TABLES = _tables()
INPUT_COLUMNS = list(dict.fromkeys(c for table in TABLES.values() for c in [*table.columns, *CALENDAR]))


def result_table(flights: DataFrame, name: str, in_order: bool = False) -> DataFrame:
    """One result table straight from the flights."""
    table = TABLES[name]
    rows, keys = flights.select(*table.columns), list(table.keys)
    if table.family == "delay":
        result = rollups.mean_by(rows, keys, MEANS)
    elif table.family == "canc_div":
        result = rollups.rate_by(rows, keys, events())
    elif table.family == "dist":
        result = rollups.total_by(rows, keys, DISTANCE)
    elif table.family == "max_consec_delay":
        result = longest_delay_run(rows, keys)
    else:
        code = F.col("CANCELLATION_CODE")
        reasons = rows.filter((F.col("CANCELLED") == 1) & code.isNotNull() & (code != ""))
        result = rollups.count_by(reasons, keys, "NUM_CANCELLED", "CANCELLED")
    return ordered(result, table.order) if in_order else result


def day_partials(flights: DataFrame) -> DataFrame:
    """Sums and counts per entity and day: one pass over the flights for all result tables."""
    return rollups.partial_rollup(
        flights.select(*INPUT_COLUMNS), DAY_GRAINS, list(MEANS.values()), list(DISTANCE.values()), events()
    )


def result_from_partials(partials: DataFrame, name: str, in_order: bool = False) -> DataFrame:
    """The same result table from the day partials."""
    table = TABLES[name]
    rows, keys = partials.filter(F.col("GRAIN") == table.entity), list(table.keys)
    if table.family == "delay":
        result = rollups.merge_means(rows, keys, MEANS)
    elif table.family == "canc_div":
        result = rollups.merge_rates(rows, keys, list(events()))
    elif table.family == "dist":
        result = rollups.merge_totals(rows, keys, DISTANCE)
    elif table.family == "max_consec_delay":
        present = rows.filter(F.col("FL_DATE").isNotNull() & (F.col("ARR_DELAY_N") > 0))
        days = rollups.merge_means(present, [*keys, "FL_DATE"], {"DAY_MEAN": "ARR_DELAY"})
        result = longest_run(days.filter(F.col("DAY_MEAN") > 0), keys, "FL_DATE", "MAX_CONSEC_DELAY_DAYS")
    else:
        code = F.col("CANCELLATION_CODE")
        result = rollups.merge_counts(rows.filter(code.isNotNull() & (code != "")), keys, "NUM_CANCELLED", "CANC_COUNT")
    return ordered(result, table.order) if in_order else result


ALL_GRAINS = {
    f"{entity}_{period}": [*entity_keys, *period_keys]
    for entity, entity_keys in ENTITIES.items()
    for period, period_keys in PERIODS.items()
}


def all_grains(flights: DataFrame) -> DataFrame:
    """Every measure at every grain in one table.

    The rows are first folded to one per carrier, route and calendar part, so
    that the eight key sets are expanded over that and not over the flights.
    """
    finest = list(dict.fromkeys(key for keys in ALL_GRAINS.values() for key in keys))
    columns = [*finest, *MEANS.values(), *DISTANCE.values(), "CANCELLED", "DIVERTED"]
    base = rollups.partials_by(
        flights.select(*columns), finest, list(MEANS.values()), list(DISTANCE.values()), events()
    )
    merged = rollups.merge_partials(base, ALL_GRAINS)
    return merged.select(
        "GRAIN",
        *finest,
        *[rollups.mean_of(column).alias(name) for name, column in MEANS.items()],
        "CANC_COUNT",
        "DIV_COUNT",
        F.col(rollups.ROWS).alias("TOTAL_FLIGHTS"),
        F.col("DISTANCE_SUM").alias("TOTAL_DISTANCE"),
    )
