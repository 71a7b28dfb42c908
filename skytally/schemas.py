"""Declared schemas: raw text, published table, wire record.

Every reader takes one of these, so no scan has to look at the data to find
its types. The name lists are fixed values of the public on-time record layout.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw columns in file order, up to the first diverted leg.
_RAW_HEAD = """
Year Quarter Month DayofMonth DayOfWeek FlightDate
Reporting_Airline DOT_ID_Reporting_Airline IATA_CODE_Reporting_Airline
Tail_Number Flight_Number_Reporting_Airline
OriginAirportID OriginAirportSeqID OriginCityMarketID Origin OriginCityName
OriginState OriginStateFips OriginStateName OriginWac
DestAirportID DestAirportSeqID DestCityMarketID Dest DestCityName
DestState DestStateFips DestStateName DestWac
CRSDepTime DepTime DepDelay DepDelayMinutes DepDel15 DepartureDelayGroups DepTimeBlk
TaxiOut WheelsOff WheelsOn TaxiIn
CRSArrTime ArrTime ArrDelay ArrDelayMinutes ArrDel15 ArrivalDelayGroups ArrTimeBlk
Cancelled CancellationCode Diverted
CRSElapsedTime ActualElapsedTime AirTime Flights Distance DistanceGroup
CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay
FirstDepTime TotalAddGTime LongestAddGTime
DivAirportLandings DivReachedDest DivActualElapsedTime DivArrDelay DivDistance
""".split()

# Columns of one diverted leg; legs are numbered 1 to 5.
_LEG_FIELDS = "Airport AirportID AirportSeqID WheelsOn TotalGTime LongestGTime WheelsOff TailNum".split()
_LEGS = range(1, 6)

RAW_COLUMNS = _RAW_HEAD + [f"Div{leg}{field}" for leg in _LEGS for field in _LEG_FIELDS]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# HHMM clock times. Leading zeros carry meaning, so no reader may type them as numbers.
CLOCK_COLUMNS = ["CRSDepTime", "DepTime", "WheelsOff", "WheelsOn", "CRSArrTime", "ArrTime", "FirstDepTime"] + [
    f"Div{leg}{field}" for leg in _LEGS for field in ("WheelsOn", "WheelsOff")
]

# Raw column, published column, published type.
_PUBLISHED = """
FlightDate                       FL_DATE              date
IATA_CODE_Reporting_Airline      OP_CARRIER           text
Flight_Number_Reporting_Airline  OP_CARRIER_FL_NUM    text
Origin                           ORIGIN               text
OriginCityName                   OriginCityName       text
OriginStateName                  OriginStateName      text
Dest                             DEST                 text
DestCityName                     DestCityName         text
DestStateName                    DestStateName        text
CRSDepTime                       CRSDepTime           text
DepTime                          DepTime              text
DepDelay                         DEP_DELAY            float
DepDelayMinutes                  DepDelayMinutes      float
DepDel15                         DepDel15             float
TaxiOut                          TAXI_OUT             float
WheelsOff                        WheelsOff            text
WheelsOn                         WheelsOn             text
TaxiIn                           TAXI_IN              float
CRSArrTime                       CRSArrTime           text
ArrTime                          ArrTime              text
ArrDelay                         ARR_DELAY            float
ArrDelayMinutes                  ArrDelayMinutes      float
ArrDel15                         ArrDel15             float
Cancelled                        CANCELLED            flag
CancellationCode                 CANCELLATION_CODE    text
Diverted                         DIVERTED             flag
CRSElapsedTime                   CRSElapsedTime       float
ActualElapsedTime                ACTUAL_ELAPSED_TIME  float
AirTime                          AIR_TIME             float
Distance                         DISTANCE             float
CarrierDelay                     CARRIER_DELAY        float
WeatherDelay                     WEATHER_DELAY        float
NASDelay                         NAS_DELAY            float
SecurityDelay                    SECURITY_DELAY       float
LateAircraftDelay                LATE_AIRCRAFT_DELAY  float
"""

PUBLISHED_COLUMNS = [tuple(line.split()) for line in _PUBLISHED.strip().splitlines()]
DERIVED_COLUMNS = ["YEAR", "MONTH", "DAYOFMONTH", "DAYOFWEEK", "IS_DELAY"]

_TYPES = {"date": T.DateType(), "text": T.StringType(), "float": T.FloatType(), "flag": T.IntegerType()}

PROCESSED_SCHEMA = T.StructType(
    [T.StructField(name, _TYPES[kind]) for _, name, kind in PUBLISHED_COLUMNS]
    + [T.StructField(name, T.IntegerType()) for name in DERIVED_COLUMNS]
)

# Wire fields that carry numbers; every other field is text.
WIRE_NUMBERS = (
    """
DepDelay DepDelayMinutes DepDel15 TaxiOut TaxiIn ArrDelay ArrDelayMinutes ArrDel15
Cancelled Diverted CRSElapsedTime ActualElapsedTime AirTime Flights Distance
CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay
TotalAddGTime LongestAddGTime DivActualElapsedTime DivArrDelay DivDistance
""".split()
    + [f"Div{leg}{field}" for leg in _LEGS for field in ("TotalGTime", "LongestGTime")]
)

WIRE_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c in set(WIRE_NUMBERS) else T.StringType()) for c in RAW_COLUMNS]
)

# Message fields that default to 0.0 when the text is empty.
ZERO_DEFAULT_COLUMNS = """
DepDelay DepDelayMinutes ArrDelay ArrDelayMinutes
CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay
""".split()
