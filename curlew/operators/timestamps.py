"""Mixed timestamp spellings to one UTC instant (problem 2).

An ordered cascade of anchored patterns rewrites a value into one canonical
record ``kind|y|m|d|h|mi|s|fraction|am/pm|zone``; the first pattern that matches
decides, and a value whose parts form no existing calendar day or clock time has
no instant. Everything is built-in column expressions, so the scan, the zone
lookup and the cascade are one codegen stage without Python.

Local-time policy: a local time that occurs twice is the earlier instant, one
that is skipped moves forward by the length of the gap. A zone abbreviation
states standard or summer time of the source's own zone.

Nulls, empty and unknown texts, impossible days, and sources without a known
zone (for values that need one) give no row. Repeated rows give one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names by month (English, German, Dutch; full and short forms).
MONTHS = (
    ("january", "jan", "januar", "januari", "jänner"),
    ("february", "feb", "februar", "februari"),
    ("march", "mar", "märz", "mär", "mrz", "maart", "mrt"),
    ("april", "apr"),
    ("may", "mai", "mei"),
    ("june", "jun", "juni"),
    ("july", "jul", "juli"),
    ("august", "aug", "augustus"),
    ("september", "sep", "sept"),
    ("october", "oct", "oktober", "okt"),
    ("november", "nov"),
    ("december", "dec", "dezember", "dez"),
)

_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
_AMPM = r"(?:\s*([AaPp])\.?[Mm]\.?)?"
_OFFSET = r"[+-]\d{2}:?\d{2}(?::?\d{2})?"
_ZONE = rf"(?:\s*(Z|z|{_OFFSET}|[+-]\d{{1,2}}|(?:UTC|GMT)[+-]\d{{1,2}}(?::?\d{{2}})?|[A-Z]{{2,5}}))?(?:\[[^\]]*\])?"
_NAME = r"([^\W\d_]{3,10})\.?"

DAY_US = 86400000000
OFFSET_ZONE = r"^(?:UTC|GMT)?([+-]\d{1,2})(?::?(\d{2}))?(?::?(\d{2}))?$"
# Abbreviations that mean summer time; any other means standard time.
SUMMER_ZONE = r"^([A-Z]*DT|CEST|EEST|WEST|MEST|BST)$"

# (kind, pattern, replacement). Kinds: t = day with or without clock, y-m-d order;
# n = numeric day in the source's own order (dotted days come day first everywhere); e = count of time units since 1970.
CASCADE = (
    ("e", r"^(\d{9,10}|\d{12,13}|\d{15,16}|\d{18,19})$", "e|$1||||||||"),
    ("t", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt ]?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d+))?{_ZONE})?$", "t|$1|$2|$3|$4|$5|$6|$7||$8"),
    ("t", rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:[Tt]|\s+){_CLOCK}{_AMPM}{_ZONE})?$", "t|$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    ("t", rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:,?(?:[Tt]|\s+){_CLOCK}{_AMPM}{_ZONE})?$", "t|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("n", rf"^(\d{{1,2}})[-/](\d{{1,2}})[-/](\d{{4}})(?:,?(?:[Tt]|\s+){_CLOCK}{_AMPM}{_ZONE})?$", "n|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("t", rf"(?U)^(?:[^\W\d_]{{3,10}}\.?,?\s+)?(\d{{1,2}})(?:\.\s*|\s+|-){_NAME}(?:\s+|-)(\d{{4}})(?:,?\s+{_CLOCK}{_AMPM}{_ZONE})?$", "t|$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("t", rf"(?U)^{_NAME}\s+(\d{{1,2}}),?\s+(\d{{4}})(?:,?\s+{_CLOCK}{_AMPM}{_ZONE})?$", "t|$3|$1|$2|$4|$5|$6|$7|$8|$9"),
)
DOTTED = r"^(\d{1,2})\."


def _int(c: Column) -> Column:
    return c.try_cast("int")


def canonical_parts(value: Column, dotted_by_source: bool = False) -> Column:
    """The cascade: ``value`` as ``kind|y|m|d|h|mi|s|fraction|am/pm|zone``, or null."""
    out = None
    for _, pattern, replacement in CASCADE:
        if dotted_by_source and pattern.startswith(DOTTED):
            replacement = "n" + replacement[1:]
        hit, text = value.rlike(pattern), F.regexp_replace(value, F.lit(pattern), F.lit(replacement))
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out


def zone_ids(spark) -> list[str]:
    """The zone names that Spark knows; a bounded list of the Java runtime."""
    return sorted(spark._jvm.java.util.ArrayList(spark._jvm.java.time.ZoneId.getAvailableZoneIds()))


def normalise_timestamps(
    rows: DataFrame,
    clocks: DataFrame,
    key: str = "project_uid",
    source: str = "source_database_id",
    fields: tuple[str, ...] = ("upload_date", "download_date"),
    dotted_by_source: bool = False,
) -> DataFrame:
    """(key, field_name, utc_us): microseconds since 1970 of each value of ``fields`` that names an instant.

    ``clocks`` has one row per source: ``time_zone`` (IANA name) and
    ``numeric_date_order`` (DMY or MDY). Its size decides the join: small tables
    are broadcast by Spark's own threshold, larger ones shuffle with AQE's skew
    splitting. Repeated clock rows of a source count once (the smallest). Dotted days
    come day first, unless ``dotted_by_source`` gives them the source's order too.
    """
    spark = rows.sparkSession
    known = F.array(*[F.lit(z) for z in zone_ids(spark)])
    clock = (
        clocks.select(F.col(source).alias("_src"), F.col("time_zone").alias("_tz"), F.col("numeric_date_order").alias("_order"))
        .where(F.col("_src").isNotNull())
        .groupBy("_src")
        .agg(F.min(F.struct("_tz", "_order")).alias("_c"))
        .select("_src", F.when(F.array_contains(known, F.col("_c._tz")), F.col("_c._tz")).alias("_tz"), F.col("_c._order").alias("_order"))
    )
    values = (
        rows.where(F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), F.col(source).alias("_src"), F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields])).alias("_x"))
        .select("_key", "_src", F.col("_x.f").alias("_field"), F.regexp_replace(F.col("_x.v"), r"(?U)^[\s​﻿]+|[\s​﻿]+$", "").alias("_v"))
        .where(F.col("_v").rlike(r"\d"))
        .withColumn("_p", F.split(canonical_parts(F.col("_v"), dotted_by_source), r"\|"))
    )
    df = values.join(clock, "_src", "left")
    part = lambda i: F.nullif(F.get("_p", F.lit(i)), F.lit(""))
    number = lambda c, default: F.coalesce(_int(c), F.lit(default))
    names = F.create_map(*[F.lit(x) for i, forms in enumerate(MONTHS) for name in forms for x in (name, str(i + 1))])
    # Each step names its results once, so no expression is written out twice in the next.
    df = df.select(
        "_key", "_field", "_tz", part(0).alias("_kind"), part(1).alias("_count"), F.upper(part(9)).alias("_zone"), F.lower(part(8)).alias("_half"),
        (F.col("_order") == "MDY").alias("_mdy"), (F.get("_p", F.lit(0)) == "n").alias("_numeric"),
        part(2).alias("_b"), part(3).alias("_c"), number(part(4), 0).alias("_h"), number(part(5), 0).alias("_mi"), number(part(6), 0).alias("_s"),
        number(F.rpad(F.substring(part(7), 1, 6), 6, "0"), 0).alias("_us"),
    )
    swap = F.col("_numeric") & F.col("_mdy")  # null, and so no month, where the source's order is unknown
    df = df.select(
        "_key", "_field", "_tz", "_kind", "_count", "_zone", "_mi", "_s", "_us", _int(F.col("_count")).alias("_y"),
        F.when(~swap, F.col("_b")).when(swap, F.col("_c")).alias("_b"), _int(F.when(~swap, F.col("_c")).when(swap, F.col("_b"))).alias("_d"),
        F.when(F.col("_half").isNull(), F.col("_h")).when(F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_half") == "p", 12).otherwise(0)).alias("_h"),
    )
    df = df.withColumn("_m", F.coalesce(_int(F.col("_b")), _int(F.element_at(names, F.lower("_b")))))
    clock = F.col("_h").between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59) & F.col("_m").between(1, 12) & F.col("_d").between(1, 31) & F.col("_y").between(1, 9999)
    df = df.select(
        "_key", "_field", "_tz", "_kind", "_count", "_zone",
        F.when(clock, F.unix_date(F.try_to_date(F.format_string("%04d-%02d-%02d", "_y", "_m", "_d"), "yyyy-MM-dd"))).cast("long").alias("_day"),
        ((F.col("_h") * 3600 + F.col("_mi") * 60 + F.col("_s")).cast("long") * 1000000 + F.col("_us")).alias("_us"),
        (F.unix_date(F.make_date(F.when(clock, F.col("_y")), F.lit(1), F.lit(1))).cast("long") * DAY_US).alias("_year"),
        F.regexp_extract("_zone", OFFSET_ZONE, 1).alias("_oh"), F.regexp_extract("_zone", OFFSET_ZONE, 2).alias("_om"),
    )
    df = df.withColumn("_local", F.col("_day") * DAY_US + F.col("_us"))

    def utc(local_us: Column, tz: Column) -> Column:
        return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_us), tz))

    # The zone's shifts from local to UTC in midwinter and midsummer: the smaller is summer time's.
    shifts = [utc(F.col("_year") + d * DAY_US, F.col("_tz")) - (F.col("_year") + d * DAY_US) for d in (14, 195)]
    df = df.withColumn("_shifts", F.when(F.col("_zone").rlike("^[A-Z]+$"), F.sort_array(F.array(*shifts))))
    hours, minutes = F.abs(_int(F.col("_oh"))), number(F.col("_om"), 0)
    offset = F.when((hours <= 18) & (minutes < 60), (hours * 3600 + minutes * 60).cast("long") * 1000000 * F.when(F.col("_oh").startswith("-"), -1).otherwise(1))
    digits, count = F.length("_count"), F.col("_count").try_cast("long")
    epoch = F.when(digits <= 10, count * 1000000).when(digits <= 13, count * 1000).when(digits <= 16, count).otherwise(F.expr("try_cast(_count AS bigint) div 1000"))
    instant = (
        F.when(F.col("_kind") == "e", epoch)
        .when(F.col("_zone").isNull(), utc(F.col("_local"), F.col("_tz")))
        .when(F.col("_zone").isin("Z", "UTC", "GMT", "UT"), F.col("_local"))
        .when(F.col("_oh") != "", F.col("_local") - offset)
        .otherwise(F.col("_local") + F.get("_shifts", F.when(F.col("_zone").rlike(SUMMER_ZONE), 0).otherwise(1)))
    )
    # Grouping makes rows distinct; the filter names the count so that it isn't pushed below the cascade and evaluated twice.
    return (
        df.select(F.col("_key").alias(key), F.col("_field").alias("field_name"), instant.alias("utc_us"))
        .groupBy(key, "field_name", "utc_us")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.when(F.col("_n") > 0, F.col("utc_us")).isNotNull())
        .drop("_n")
    )
