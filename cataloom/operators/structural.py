"""Structural profile: types, distinct counts, coverage, profile text.

Two forms.  Samples are profiled inside the row that holds them (no shuffle).  Typed tables are
profiled by aggregates over the whole table.  Coverage is the exact minimum and maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prompts import PROFILE_HEADING
from ..functions.text import elements, let
from .sampling import with_table

# What the texts of a type look like.
INTEGER = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN = "^(?i)(true|false|yes|no)$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?)?)?$"
# Dates as portals write them, with a time of day at the end: 01/31/2020, 2020/01/31, 31 Jan 2020,
# January 31, 2020.
CLOCK = r"(?:,?[ T]([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.[0-9]+)?)? ?([AaPp][Mm])?)?$"
NUMERIC_DATE = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})" + CLOCK
OVER_12_FIRST = r"^(1[3-9]|[2-9][0-9])[/.-][0-9]{1,2}[/.-][0-9]{4}" + CLOCK
YEAR_FIRST = r"^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})" + CLOCK
DAY_MONTH = r"^([0-9]{1,2})[ -]([A-Za-z]{3})[a-z]*\.?[ ,-]+([0-9]{4})" + CLOCK
MONTH_DAY = r"^([A-Za-z]{3})[a-z]*\.? ([0-9]{1,2}),? ([0-9]{4})" + CLOCK
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Groups that hold year, month, day; None: the rule of the column decides between month and day.
FORMS = {NUMERIC_DATE: (3, None, None), YEAR_FIRST: (1, 2, 3), DAY_MONTH: (3, 2, 1), MONTH_DAY: (3, 1, 2)}
POINT = r"^(?i)(point ?)?\(-?[0-9.]+[ ,]+-?[0-9.]+\)$"
LATITUDE = "^(?i)lat(itude)?$"
LONGITUDE = "^(?i)(lon|lng|long|longitude)$"


def _all(values: Column, pattern: str) -> Column:
    return F.forall(values, lambda v: v.rlike(pattern))


# The parts of a double in scientific notation, as Spark writes it.
SCIENTIFIC = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"


def _day_first(values: Column) -> Column:
    """Numeric dates are month first, as in the United States, unless a first number exceeds 12."""
    return F.exists(values, lambda v: v.rlike(OVER_12_FIRST))


def _month(text: Column) -> Column:
    place = F.instr(F.lit(MONTHS), F.lower(text))
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).when((place > 0) & (place % 3 == 1), ((place + 2) / 3).cast("int"))


def moment(value: Column, day_first: Column) -> Column:
    """The time a text tells, in ISO form or one of ``FORMS``; null when it tells none."""
    out = F.when(value.rlike(DATE), F.try_to_timestamp(value))
    for form, (year, month, day) in FORMS.items():
        part = [F.regexp_extract(value, form, i) for i in range(8)]
        first, second = (part[1], part[2]) if month is None else (part[month], part[day])
        m = F.when(day_first, second).otherwise(first) if month is None else first
        d = F.when(day_first, first).otherwise(second) if month is None else second
        clock = [F.coalesce(part[i].try_cast("int"), F.lit(0)) for i in (4, 5, 6)]
        half = F.lower(part[7])
        hour = F.when(half == "", clock[0]).when(clock[0].between(1, 12), clock[0] % 12 + F.when(half == "pm", 12).otherwise(0))
        made = F.try_make_timestamp(part[year].try_cast("int"), _month(m), d.try_cast("int"), hour, clock[1], clock[2].cast("decimal(16,6)"))
        out = out.when(value.rlike(form), made)
    return out


def _tells_time(values: Column) -> Column:
    """True when every value is a time, by forms that are tried only where they fit."""
    looks = F.forall(values, lambda v: v.rlike("^[0-9A-Za-z]") & v.rlike("[0-9]{4}") & v.rlike("[/. -]"))
    return looks & F.forall(values, lambda v: moment(v, _day_first(values)).isNotNull())


def number_text(value: Column) -> Column:
    """A double in the fewest digits that tell it: ``0`` for zero, else at least one decimal place,
    with an exponent from 1e16 up and below 1e-4.  Any double has a text."""

    def plain(t: Column) -> Column:
        sign, first, rest, power = (F.regexp_extract(t, SCIENTIFIC, i) for i in (1, 2, 3, 4))
        tail = F.when(rest == "0", F.lit("")).otherwise(rest)
        digits = F.concat(first, tail)
        exponent = F.when(t.contains("E"), power).otherwise("0").cast("int")
        whole = F.rpad(digits, exponent + 1, "0")
        behind = F.substr(digits, exponent + 2)
        large = F.concat(sign, whole, F.lit("."), F.when(behind == "", F.lit("0")).otherwise(behind))
        small = F.concat(sign, F.lit("0.000"), digits)
        mantissa = F.concat(sign, first, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("."), tail)))
        size = F.abs(exponent).cast("string")
        shown = F.concat(
            mantissa,
            F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
            F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size),
        )
        return (
            F.when(~t.contains("E"), t)
            .when((exponent > 0) & (exponent < 16), large)
            .when(exponent == -4, small)
            .otherwise(shown)
        )

    return F.when(value == 0, F.lit("0")).otherwise(let(value.cast("string"), plain))


def _range_low(low: Column) -> Column:
    """The printed range starts at 0 at the latest."""
    return F.when(low.isNotNull(), F.least(F.lit(0.0), low))


def _range_high(high: Column) -> Column:
    return F.when(high.isNotNull(), F.greatest(F.lit(0.0), high))


def sample_profiles(df: DataFrame, column: str = "sample_csv") -> DataFrame:
    """Add ``profile``: one struct per column of the sample in the row.

    Fields: ``col_no, col_name, data_type, distinct_values, low, high, range_low, range_high,
    first_time, last_time, resolution, spatial_type``.
    """
    parsed = with_table(df, column)
    typed = F.transform(
        "columns",
        lambda c: F.struct(
            c["col_no"].alias("col_no"),
            c["col_name"].alias("col_name"),
            F.filter(c["values"], lambda v: v.isNotNull()).alias("found"),
        ),
    )
    kinds = F.transform(
        "_found",
        lambda c: F.struct(
            c["col_no"].alias("col_no"),
            c["col_name"].alias("col_name"),
            c["found"].alias("found"),
            F.when(F.size(c["found"]) == 0, "missingdata")
            .when(_all(c["found"], INTEGER), "integer")
            .when(_all(c["found"], NUMBER), "float")
            .when(_all(c["found"], BOOLEAN), "boolean")
            .when(_tells_time(c["found"]), "datetime")
            .otherwise("text")
            .alias("data_type"),
        ),
    )
    measured = F.transform(
        "_kinds",
        lambda c: F.struct(
            c["col_no"].alias("col_no"),
            c["col_name"].alias("col_name"),
            c["data_type"].alias("data_type"),
            F.size(F.array_distinct(c["found"])).alias("distinct_values"),
            F.when(
                c["data_type"].isin("integer", "float"),
                F.transform(c["found"], lambda v: v.try_cast("double")),
            ).alias("numbers"),
            F.when(
                c["data_type"] == "datetime",
                let(_day_first(c["found"]), lambda d: F.transform(c["found"], lambda v: moment(v, d))),
            ).alias("times"),
            _all(c["found"], POINT).alias("is_point"),
        ),
    )
    profile = F.transform(
        "_measured",
        lambda c: F.struct(
            c["col_no"].alias("col_no"),
            c["col_name"].alias("col_name"),
            c["data_type"].alias("data_type"),
            c["distinct_values"].alias("distinct_values"),
            F.array_min(c["numbers"]).alias("low"),
            F.array_max(c["numbers"]).alias("high"),
            F.array_min(c["times"]).alias("first_time"),
            F.array_max(c["times"]).alias("last_time"),
            F.when(c["times"].isNotNull(), _resolution(c["times"])).alias("resolution"),
            F.when(
                (c["col_name"].rlike(LATITUDE) & _within(c["numbers"], 90))
                | (c["col_name"].rlike(LONGITUDE) & _within(c["numbers"], 180)),
                "latlong",
            )
            .when((c["data_type"] == "text") & c["is_point"], "point")
            .alias("spatial_type"),
        ),
    )
    return (
        parsed.withColumn("_found", typed)
        .withColumn("_kinds", kinds)
        .withColumn("_measured", measured)
        .withColumn("profile", profile)
        .drop("_found", "_kinds", "_measured")
    )


def _resolution(times: Column) -> Column:
    """Finest unit in use."""
    return (
        F.when(F.exists(times, lambda t: F.second(t) != 0), "second")
        .when(F.exists(times, lambda t: F.minute(t) != 0), "minute")
        .when(F.exists(times, lambda t: F.hour(t) != 0), "hour")
        .when(F.exists(times, lambda t: F.dayofmonth(t) != 1), "day")
        .when(F.exists(times, lambda t: F.month(t) != 1), "month")
        .otherwise("year")
    )


def _within(numbers: Column, limit: int) -> Column:
    inside = F.forall(numbers, lambda x: F.abs(x) <= limit)
    return F.coalesce(inside & (F.size(numbers) > 0), F.lit(False))


def profile_rows(df: DataFrame, column: str = "sample_csv") -> DataFrame:
    """One row per column of every sample, ranges folded with 0 as :func:`profile_text` prints."""
    return (
        sample_profiles(df.select("dataset_id", column), column)
        .select("dataset_id", F.explode(elements("profile")).alias("p"))
        .select("dataset_id", "p.*")
        .withColumn("range_low", _range_low(F.col("low")))
        .withColumn("range_high", _range_high(F.col("high")))
    )


def profile_text(profile: Column) -> Column:
    """Heading and one line per column.  The printed range always includes 0."""
    line = F.transform(
        profile,
        lambda p: F.concat(
            F.lit("**"),
            p["col_name"],
            F.lit("**: Data is of type "),
            p["data_type"],
            F.lit(". There are "),
            p["distinct_values"].cast("string"),
            F.lit(" unique values. "),
            F.coalesce(
                F.concat(
                    F.lit("Coverage spans from "),
                    number_text(_range_low(p["low"])),
                    F.lit(" to "),
                    number_text(_range_high(p["high"])),
                    F.lit(". "),
                ),
                F.lit(""),
            ),
        ),
    )
    return F.concat(F.lit(PROFILE_HEADING + "\n"), F.array_join(line, "\n"))


def coverage_notes(profile: Column) -> Column:
    """One line per temporal column, then one line per kind of spatial columns."""
    temporal = F.transform(
        F.filter(profile, lambda p: p["first_time"].isNotNull()),
        lambda p: F.concat(
            F.lit("**Temporal coverage** for columns "),
            p["col_name"],
            F.lit(" with resolution "),
            p["resolution"],
            F.lit(", covering from "),
            F.date_format(p["first_time"], "yyyy-MM-dd"),
            F.lit(" to "),
            F.date_format(p["last_time"], "yyyy-MM-dd"),
            F.lit("."),
        ),
    )

    def spatial(kind: str) -> Column:
        names = F.transform(
            F.filter(profile, lambda p: F.coalesce(p["spatial_type"] == kind, F.lit(False))),
            lambda p: p["col_name"],
        )
        note = F.concat(
            F.lit("**Spatial coverage** for columns "),
            F.array_join(names, ", "),
            F.lit(f", with type {kind}."),
        )
        return F.when(F.size(names) > 0, F.array(note)).otherwise(
            F.array().cast("array<string>")
        )

    return F.array_join(F.concat(temporal, spatial("latlong"), spatial("point")), "\n")


def render_profiles(df: DataFrame, column: str = "sample_csv") -> DataFrame:
    """Add ``dataset_profile`` and ``profile_notes`` to every record."""
    return sample_profiles(df, column).withColumn(
        "dataset_profile", profile_text(F.col("profile"))
    ).withColumn("profile_notes", coverage_notes(F.col("profile")))


# --- typed tables -------------------------------------------------------------------------

_TYPE_NAMES = {
    T.LongType: "integer",
    T.IntegerType: "integer",
    T.ShortType: "integer",
    T.ByteType: "integer",
    T.DoubleType: "float",
    T.FloatType: "float",
    T.DecimalType: "float",
    T.BooleanType: "boolean",
    T.DateType: "datetime",
    T.TimestampType: "datetime",
    T.TimestampNTZType: "datetime",
}


def declared_type(field: T.StructField) -> str:
    return _TYPE_NAMES.get(type(field.dataType), "text")


def _plain_fields(df: DataFrame) -> list[tuple[int, T.StructField]]:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [(i, f) for i, f in enumerate(df.schema.fields) if not isinstance(f.dataType, nested)]


def table_ranges(df: DataFrame) -> DataFrame:
    """One row per column of a typed table: type, null count, range; a single scan, no shuffle
    beyond one partial row per task."""
    fields = _plain_fields(df)
    parts: list[Column] = []
    for i, f in fields:
        kind, c = declared_type(f), F.col(f.name)
        number = c.cast("double") if kind in ("integer", "float") else F.lit(None).cast("double")
        time = c.cast("timestamp_ntz") if kind == "datetime" else F.lit(None).cast("timestamp_ntz")

        def unit(part, rest: int):
            used = F.coalesce(F.bool_or(part(time) != rest), F.lit(False))
            return used

        parts += [
            F.count_if(c.isNull()).alias(f"nulls_{i}"),
            F.min(number).alias(f"low_{i}"),
            F.max(number).alias(f"high_{i}"),
            F.min(time).alias(f"first_{i}"),
            F.max(time).alias(f"last_{i}"),
            (
                F.when(F.count(time) == 0, F.lit(None).cast("string"))
                .when(unit(F.second, 0), "second")
                .when(unit(F.minute, 0), "minute")
                .when(unit(F.hour, 0), "hour")
                .when(unit(F.dayofmonth, 1), "day")
                .when(unit(F.month, 1), "month")
                .otherwise("year")
            ).alias(f"unit_{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("col_no"),
                F.lit(f.name).alias("col_name"),
                F.lit(declared_type(f)).alias("data_type"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.col(f"low_{i}").alias("low"),
                F.col(f"high_{i}").alias("high"),
                F.col(f"first_{i}").alias("first_time"),
                F.col(f"last_{i}").alias("last_time"),
                F.col(f"unit_{i}").alias("resolution"),
            )
            for i, f in fields
        ]
    )
    return (
        df.agg(*parts)
        .select(F.explode(rows).alias("c"))
        .select("c.*")
        .withColumn("range_low", _range_low(F.col("low")))
        .withColumn("range_high", _range_high(F.col("high")))
    )


def table_distinct_counts(df: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct values per column of a typed table.

    Exact: (column, value) pairs are reduced in every task before they move, so a value that
    fills a third of a column costs one row per task.  ``exact=False`` uses sketches.
    """
    fields = _plain_fields(df)
    if not exact:
        sketches = df.agg(*[F.approx_count_distinct(f.name).alias(f"d{i}") for i, f in fields])
        rows = F.array(
            *[
                F.struct(F.lit(i).alias("col_no"), F.col(f"d{i}").alias("distinct_values"))
                for i, _ in fields
            ]
        )
        return sketches.select(F.explode(rows).alias("c")).select("c.*")
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("col_no"), F.col(f.name).cast("string").alias("value"))
            for i, f in fields
        ]
    )
    pairs = df.select(F.explode(cells).alias("c")).select("c.*").groupBy("col_no", "value")
    return (
        pairs.agg(F.count(F.lit(1)).alias("n"))
        .groupBy("col_no")
        .agg(F.count("value").alias("distinct_values"))
    )


def profile_table(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, null count, distinct count and ranges of every column of a typed table.

    Both sides of the join have one row per column of the table's schema.
    """
    ranges = table_ranges(df)
    return ranges.join(F.broadcast(table_distinct_counts(df, exact)), "col_no", "left")
