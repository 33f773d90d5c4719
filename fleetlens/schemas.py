"""Record types as explicit Spark schemas, and the column contract every operator checks.

Event times are ``TIMESTAMP`` (session zone UTC).  ``seq`` is the arrival number of a record inside
its stream; it makes every "first"/"last" rule exact where event times tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# States, report kinds, tags, alert texts and levels of the data model.
OPEN, CLOSE, OBSTRUCTED = "OPEN", "CLOSE", "OBSTRUCTED"
BROKEN_DOWN, DISSATISFIED, SATISFIED = "BROKEN_DOWN", "DISSATISFIED", "SATISFIED"
COMPLAINTS = (BROKEN_DOWN, DISSATISFIED)
PRIMARY, SECONDARY = "PRIMARY", "SECONDARY"
CELSIUS, FAHRENHEIT = "CELSIUS", "FAHRENHEIT"
UNITS_DEVIATION = "SENSOR DIFF CELSIUS"
UNITS_TEMPERATURE = "MALFUNCTIONING TEMPERATURE"
UNITS_OBSTRUCTED = "MALFUNCTIONING OBSTRUCTED"
UNITS_NOT_OPENING = "MALFUNCTIONING NOT OPENING TIMES "
LEVEL_TEMPERATURE, LEVEL_OBSTRUCTED, LEVEL_PATTERN = 2, 3, 5
SENSORS_PER_VEHICLE = 100
WATERMARK_DELAY = "3500 milliseconds"


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, False) for name, kind in fields])


_TS, _LONG, _STR, _DBL = T.TimestampType(), T.LongType(), T.StringType(), T.DoubleType()
_INT, _BOOL = T.IntegerType(), T.BooleanType()

MEASUREMENT = _schema(("ts", _TS), ("sensor_id", _LONG), ("units", _STR), ("value", _DBL), ("seq", _LONG))
TAGGED_READING = _schema(("type", _STR), *[(f.name, f.dataType) for f in MEASUREMENT])
VALVE_STATE = _schema(("ts", _TS), ("sensor_id", _LONG), ("state", _STR), ("seq", _LONG))
OBSERVED_STATE = _schema(("ts", _TS), ("sensor_id", _LONG), ("value", _DBL), ("state", _STR), ("seq", _LONG))
CUSTOMER_REPORT = _schema(
    ("ts", _TS), ("vehicle_id", _LONG), ("customer_name", _STR), ("value", _STR), ("seq", _LONG)
)
SENSOR_ALERT = _schema(
    ("ts", _TS), ("sensor_id", _LONG), ("units", _STR), ("value", _DBL), ("level", _INT), ("seq", _LONG)
)
VEHICLE_STATE = _schema(("vehicle_id", _LONG), ("moving", _INT), ("ts", _TS))
OWNER = _schema(("vehicle_id", _LONG), ("owner_name", _STR), ("reported_stolen", _BOOL))
SENSOR_REFERENCE = _schema(
    ("sensor_id", _LONG), ("lon", _DBL), ("lat", _DBL),
    ("important_metadata", _STR), ("more_important_metadata", _STR),
)
EDIT = _schema(("ts", _TS), ("user", _STR), ("byte_diff", _LONG), ("seq", _LONG))
TEXT_LINE = _schema(("value", _STR))


def expect(df: DataFrame, schema: T.StructType, *names: str) -> DataFrame:
    """Check that ``df`` has the named columns of ``schema`` (all of them by default) with its types.

    Looks at the analysed schema only, so it starts no job and works on streams.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = []
    for field in schema.fields:
        if names and field.name not in names:
            continue
        if field.name not in have:
            wrong.append(f"{field.name} missing")
        elif have[field.name] != field.dataType:
            wrong.append(f"{field.name} is {have[field.name].simpleString()}, "
                         f"not {field.dataType.simpleString()}")
    if wrong:
        raise ValueError("input does not match the record type: " + "; ".join(wrong))
    return df
