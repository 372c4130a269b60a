"""Times as people and systems write them, as arrays of valid readings.

A reading is ``struct<kind int, us bigint, cost double>``: the format, the
instant in microseconds since 1970 (UTC), and what the reading costs before its
neighbours are looked at. All expressions stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

READING = "array<struct<kind:int,us:bigint,cost:double>>"

# Offsets in minutes of the zone letters used in the United States and Europe.
ZONE_LETTERS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600,
    "wet": 0, "west": 60, "bst": 60, "ist": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180,
}

# The first three letters of the months.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

# Number words up to twelve, and words of relative dates, in English, German, French and Spanish.
NUMBER_WORDS = {
    "a": 1, "an": 1, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12,
    "einem": 1, "einer": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9, "zehn": 10, "elf": 11, "zwölf": 12,
    "un": 1, "une": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9, "dix": 10, "onze": 11, "douze": 12,
    "una": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12,
}
TODAY = "today|heute|aujourd['’]?hui|hoy"
YESTERDAY = "yesterday|gestern|hier|ayer"
UNITS = {
    "hour": "hours?|hrs?|stunden?|heures?|horas?",
    "day": "days?|tag|tagen?|jours?|d[ií]as?",
    "week": "weeks?|wochen?|semaines?|semanas?",
}

#: Kinds of readings. The four epoch kinds differ by the unit of the number.
KIND_ISO, KIND_SLASH, KIND_DOT, KIND_NAMED, KIND_BASIC, KIND_RELATIVE = 0, 1, 2, 3, 4, 5
KIND_SLASH_DAY, KIND_DOT_MONTH = 14, 15
EPOCH_UNITS = ((10, 1_000_000, 1), (11, 1_000, 1), (12, 1, 1), (13, 1, 1_000))  # kind, times, divided by

#: A number is read in a unit only if the instant lies before this year's end (the range of nanoseconds in 64 bits).
LAST_US = 9_223_372_036_854_775
#: Readings before this instant (1990) are possible but unlikely for a posting.
ERA_START_US = 631_152_000_000_000
COST_BEFORE_ERA, COST_AFTER_ERA = 20.0, 20.0
ERA_END_US = 4_102_444_800_000_000  # 2100
#: A reading against what the task states: day before month with slashes, month before day with dots, the later of two
#: instants, the offset after the change. More than two changes of format and two jumps back can save.
COST_UNUSUAL = 20.0

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000


def zone_ids(spark: SparkSession) -> list[str]:
    """The region names the JVM knows, so that none is looked up in vain."""
    names = spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds()
    return sorted(n for n in names if "/" in n)


def _lookup(keys: Column, values: dict[str, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), keys)


def _reading(kind: int | Column, us: Column, cost: Column | float = 0.0) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    cost = F.lit(cost) if isinstance(cost, float) else cost
    return F.struct(kind.cast("int").alias("kind"), us.cast("bigint").alias("us"), cost.cast("double").alias("cost"))


def epoch_readings(number: Column) -> Column:
    """A positive count since 1970 read as seconds, milli-, micro- and nanoseconds, as far as each is in range.

    Parts finer than microseconds are cut off. Null, zero and negative numbers have no reading.
    """
    readings = []
    for kind, times, over in EPOCH_UNITS:
        n = number.cast("bigint")
        us = F.when((n > 0) & (n <= min(LAST_US * over // times, 2**63 - 1)), n * F.lit(times) if over == 1 else F.floor(n.cast("decimal(20,0)") / F.lit(over)).cast("bigint"))
        cost = F.when(us < ERA_START_US, COST_BEFORE_ERA).when(us > ERA_END_US, COST_AFTER_ERA).otherwise(0.0)
        readings.append(F.when(us.isNotNull(), _reading(kind, us, cost)))
    return F.filter(F.array(*readings), lambda x: x.isNotNull())


#: One pattern for every calendar form, after the date has been brought to year-month-day.
_CALENDAR = (
    r"^([0-9]{4})-([0-9]{1,2}|[A-Za-z]{3,9})-([0-9]{1,2})"
    r"(?:(?:[Tt]|\s+at\s+|,?\s+)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)?\s*([AaPp][Mm](?![A-Za-z]))?)?"
    r"\s*(\[?[A-Za-z]+(?:[/_+-][A-Za-z_0-9+-]+)*\]?|[+-][0-9]{2}(?::?[0-9]{2})?)?$"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def calendar_readings(text: Column, zone: Column, zones: list[str]) -> Column:
    """Readings of a calendar date with or without time and zone.

    Slashes put the month first, dots the day. Without zone it is wall time in
    ``zone`` (null: UTC). Wall time that occurs twice is the earlier instant,
    skipped wall time is read with the offset before the change (both as
    ``to_utc_timestamp`` does). That reading comes first, at no cost; where day and
    month can change places, or the zone changes its offset around that wall time,
    the others follow at COST_UNUSUAL. Dates that are impossible as stated, and
    unknown zones: no reading.
    """

    def brought_to_year_month_day(v: Column) -> Column:
        c = F.regexp_replace(v, r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")
        for pattern, to in (
            (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?![0-9])", "$3-$1-$2"),
            (r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})(?![0-9])", "$3-$2-$1"),
            (r"^([0-9]{1,2})\s+([A-Za-z]{3,9})\.?,?\s+([0-9]{4})(?![0-9])", "$3-$2-$1"),
            (r"^([A-Za-z]{3,9})\.?\s+([0-9]{1,2}),?\s+([0-9]{4})(?![0-9])", "$3-$1-$2"),
            (r"^([0-9]{4})([0-9]{2})([0-9]{2})[Tt]([0-9]{2})([0-9]{2})([0-9]{2})", "$1-$2-$3T$4:$5:$6"),
            (r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3"),
        ):
            c = F.regexp_replace(c, pattern, to)
        return c

    def local_us(parts: Column) -> Column:
        number = lambda i: F.coalesce(parts[i].try_cast("int"), F.lit(0))
        month = F.coalesce(parts[1].try_cast("int"), _lookup(F.lower(F.substring(parts[1], 1, 3)), {m: i + 1 for i, m in enumerate(MONTHS)}))
        half = F.lower(parts[7])
        hour = (
            F.when(half == "", number(3))
            .when(~number(3).between(1, 12), F.lit(None))
            .otherwise(number(3) % 12 + F.when(half == "pm", 12).otherwise(0))
        )
        seconds = F.when(number(5) < 60, number(5)).cast("decimal(16,6)")
        whole = F.try_make_timestamp(parts[0].try_cast("int"), month, parts[2].try_cast("int"), hour, number(4), seconds, F.lit("UTC"))
        micros = F.coalesce(F.substring(F.rpad(parts[6], 6, "0"), 1, 6).try_cast("bigint"), F.lit(0))
        return F.unix_micros(whole) + micros

    def instants(local: Column, name: Column) -> Column:
        """The instant of wall time in a zone, and after it the other one where its offset changes; null without a zone that is known."""
        digits = F.regexp_replace(name, "[^0-9]", "")
        offset = F.when(
            name.rlike(r"^[+-]"),
            F.when(F.substring(name, 1, 1) == "-", -1).otherwise(1)
            * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))),
        ).otherwise(_lookup(F.lower(name), ZONE_LETTERS))
        region = F.when(name == "", F.coalesce(zone, F.lit("UTC"))).otherwise(name)
        known = F.when(region.isin([*zones, "UTC"]), region)
        fixed = local - offset.cast("bigint") * 60_000_000

        def in_region(z: Column) -> Column:
            wall = lambda us: F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(us), z))
            # Offsets a day before and a day after tell whether there is another reading; the usual one is the JVM's.
            usual = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local), z))
            offsets = F.array(*[wall(local + d) - (local + d) for d in (-DAY_US, DAY_US)])
            both = F.transform(offsets, lambda o: local - o)
            # Twice: the later instant has the same wall time. Skipped: neither has it, the other lies before the usual one.
            other = lambda u: F.filter(both, lambda x: (x != u) & ((wall(x) == local) | (wall(u) != local)))
            return F.when(offsets[0] == offsets[1], F.array(usual)).otherwise(let(usual, lambda u: F.concat(F.array(u), F.array_distinct(other(u)))))

        return F.when(offset.isNotNull(), F.array(fixed)).when(known.isNotNull(), let(F.coalesce(known, F.lit("UTC")), in_region))

    def kind(v: Column) -> Column:
        return (
            F.when(v.rlike(r"^[0-9]{1,2}/"), KIND_SLASH)
            .when(v.rlike(r"^[0-9]{1,2}\."), KIND_DOT)
            .when(v.rlike(r"^[0-9]{8}[Tt]"), KIND_BASIC)
            .when(v.rlike(r"^[0-9]{4}-"), KIND_ISO)
            .otherwise(KIND_NAMED)
        )

    def readings(v: Column) -> Column:
        split = lambda c: F.when(c.rlike(_CALENDAR), F.split(F.regexp_replace(c, _CALENDAR, "\u0001".join(f"${i}" for i in range(1, 10))), "\u0001"))
        turned = F.regexp_replace(v, r"^([0-9]{1,2})([/.])([0-9]{1,2})([/.][0-9]{4})", "$3$2$1$4")
        all_us = lambda c: let(
            let(brought_to_year_month_day(c), split),
            lambda parts: let(local_us(parts), lambda local: F.when(local.isNotNull(), instants(local, F.regexp_replace(parts[8], r"[\[\]]", "")))),
        )
        costly = lambda us, k: F.transform(us, lambda x: _reading(k, x, COST_UNUSUAL))
        stated = let(all_us(v), lambda us: F.when(us[0].isNotNull(), F.transform(us, lambda x, i: _reading(kind(v), x, F.when(i == 0, 0.0).otherwise(COST_UNUSUAL)))))
        other_kind = F.when(v.rlike(r"^[0-9]{1,2}/"), KIND_SLASH_DAY).otherwise(KIND_DOT_MONTH)
        others = F.when(v.rlike(r"^([0-9]{1,2})[/.][0-9]{1,2}[/.][0-9]{4}") & (turned != v), F.coalesce(costly(all_us(turned), other_kind), F.array().cast(READING))).otherwise(F.array().cast(READING))
        return F.when(stated.isNotNull(), F.concat(stated, others))

    return let(trimmed(text), readings)


def text_readings(text: Column, zone: Column, zones: list[str]) -> Column:
    """Readings of a text that holds a calendar time or a count since 1970; empty where it states none."""
    none = F.array().cast(READING)
    number = lambda v: F.when(v.rlike(r"^[0-9]{9,19}$"), v.try_cast("bigint"))
    epochs = lambda n: F.when(n.isNotNull(), epoch_readings(n))
    return let(trimmed(text), lambda v: F.coalesce(let(number(v), epochs), calendar_readings(v, zone, zones), none))


def relative_readings(text: Column, captured: Column, zones: list[str]) -> Column:
    """Readings of "3 days ago", "Gestern ausgeschrieben" or a date, seen from ``captured``.

    Days and weeks count back from the UTC day of ``captured``; hours from
    ``captured`` itself; a date is 00:00 UTC. "30+ days ago" states no time.
    """
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), captured.cast("timestamp_ntz"))
    amount = rf"(?<![\p{{L}}0-9])([0-9]{{1,5}}|{'|'.join(sorted(NUMBER_WORDS, key=len, reverse=True))})\s+(?:%s)(?![\p{{L}}0-9])"

    def count(v: Column, unit: str) -> Column:
        word = F.regexp_extract(v, amount % UNITS[unit], 1)
        return F.coalesce(word.try_cast("bigint"), _lookup(word, NUMBER_WORDS).cast("bigint"))

    word = lambda v, words: v.rlike(rf"(?<![\p{{L}}])(?:{words})(?![\p{{L}}])")

    def instant(v: Column) -> Column:
        day = at - F.pmod(at, F.lit(DAY_US))
        back = F.coalesce(
            at - count(v, "hour") * HOUR_US,
            day - count(v, "day") * DAY_US,
            day - count(v, "week") * (7 * DAY_US),
            F.when(word(v, YESTERDAY), day - DAY_US),
            F.when(word(v, TODAY), day),
        )
        return F.when(~v.rlike(r"[0-9]\s*\+|\+\s*[0-9]"), back)

    relative = let(F.lower(trimmed(text)), instant)
    bare = F.regexp_replace(text, r"^(?i)[\s\p{Z}]*(posted|ausgeschrieben|publié|publicado)(\s+(on|am|le|el))?\s+", "")
    none = F.array().cast(READING)
    readings = let(relative, lambda us: F.when(us.isNotNull(), F.array(_reading(KIND_RELATIVE, us))))
    return F.coalesce(readings, calendar_readings(bare, F.lit(None).cast("string"), zones), none)
