"""Mixed timestamp strings to one UTC instant.

An ordered cascade of anchored patterns reads a string into calendar fields, strictly: a
value that fits no pattern, or whose fields make no date, gives null. The zone of a value
without one comes from a lookup by source. Everything is a Column expression, so the work
stays in the JVM; the month and zone tables are a few dozen literal rows.

Defined results: null, blank and unreadable values give null; of two instants with one
wall-clock time the earlier counts; a wall-clock time that the zone skips gives null; a
value without a zone whose source has no known zone gives null. Rows are kept as they
are, repeated ones too; the input may hold any other columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits of Devanagari, English month names, offsets of zone abbreviations by zone.
DEVANAGARI_DIGITS = "०१२३४५६७८९"
ENGLISH_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ABBREVIATIONS = {
    "Asia/Kathmandu": {"NPT": 20700, "NST": 20700},
    "Asia/Kolkata": {"IST": 19800},
    "America/New_York": {"EST": -18000, "EDT": -14400},
    "Europe/London": {"GMT": 0, "BST": 3600},
    "Australia/Sydney": {"AEST": 36000, "AEDT": 39600, "EST": 36000, "EDT": 39600},
    "*": {"UTC": 0, "GMT": 0, "UT": 0, "Z": 0},
}

_DATE = r"(\d{4})[-./](\d{1,2})[-./](\d{1,2})"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"(?:\s*(Z|[+-]\d{2}:?\d{2}|[A-Za-z]{2,5}))?(?:\[[A-Za-z0-9_+/-]+\])?"


@dataclass(frozen=True)
class Pattern:
    """One anchored pattern and the group number of each field; month_group may hold a name."""

    regex: str
    groups: Mapping[str, int]
    order: str = "ymd"


#: Tried in this order; the first that matches decides.
CASCADE: Sequence[Pattern] = (
    Pattern(rf"^{_DATE}(?:[T\s]+{_TIME}{_ZONE})?$", dict(y=1, mo=2, d=3, h=4, mi=5, s=6, f=7, z=8)),
    Pattern(r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(Z|[+-]\d{2}:?\d{2})?$", dict(y=1, mo=2, d=3, h=4, mi=5, s=6, z=7)),
    Pattern(rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})(?:\s+{_TIME}{_ZONE})?$", dict(a=1, b=2, y=3, h=4, mi=5, s=6, f=7, z=8), "by source"),
    Pattern(rf"^(?:[A-Za-z]{{3,9}},?\s+)?(\d{{1,2}})\s+([A-Za-z]{{3,9}})\.?,?\s+(\d{{4}})(?:\s+{_TIME}{_ZONE})?$", dict(d=1, name=2, y=3, h=4, mi=5, s=6, f=7, z=8)),
    Pattern(r"^(\d{1,2})\s+([A-Za-z]{3,9})\s+(\d{4})\s+(\d{2})(\d{2})\s*hrs$", dict(d=1, name=2, y=3, h=4, mi=5)),
    Pattern(r"^([A-Za-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})(?:,?\s+(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s*([AaPp][Mm]))?)?$", dict(name=1, d=2, y=3, h=4, mi=5, s=6, ampm=7)),
    Pattern(r"^([ऀ-ॣ॰-ॿ]+)\s+(\d{1,2}),?\s+(\d{4})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$", dict(native=1, d=2, y=3, h=4, mi=5, s=6)),
    Pattern(r"^(\d{4})\s+([ऀ-ॣ॰-ॿ]+)\s+(\d{1,2})(?:\s+गते)?(?:,?\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$", dict(y=1, native=2, d=3, h=4, mi=5, s=6)),
)
#: Bare numbers: digits of Unix time and the microseconds in a unit.
UNIX = ((r"^\d{9,10}$", 1_000_000), (r"^\d{12,13}$", 1_000), (r"^\d{15,16}$", 1))


@dataclass(frozen=True)
class Calendar:
    """A lunisolar calendar by table: (year, month) to first civil day and length, month names in order."""

    months: Mapping[tuple[int, int], tuple[str, int]] = field(default_factory=dict)
    names: Mapping[str, int] = field(default_factory=dict)

    @staticmethod
    def from_rows(rows: Sequence) -> "Calendar":
        return Calendar(
            {(r["bs_year"], r["bs_month"]): (str(r["first_day"]), r["days"]) for r in rows},
            {r["month_name"]: r["bs_month"] for r in rows},
        )


def _literal_map(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def normalise_digits(value: Column) -> Column:
    return F.translate(value, DEVANAGARI_DIGITS, "0123456789")


#: The parts of the canonical text, in order; `kind` is the pattern's order of date fields.
PARTS = ("kind", "y", "mo", "d", "h", "mi", "s", "f", "z", "ampm")


def _canonical(text: Column, patterns: Sequence[Pattern]) -> Column:
    """The text rewritten by the first pattern that matches, its PARTS joined by `|`, or null."""
    out = F.lit(None).cast("string")
    for p in reversed(patterns):
        groups = dict(p.groups)
        groups["mo"] = groups.get("mo") or groups.get("name") or groups.get("native") or groups.get("a")
        groups["d"] = groups.get("d") or groups.get("b")
        kind = "source" if p.order == "by source" else "native" if "native" in p.groups else "civil"
        new = "|".join([kind, *(f"${groups[k]}" if groups.get(k) else "" for k in PARTS[1:])])
        out = F.when(text.rlike(p.regex), F.regexp_replace(text, p.regex, new)).otherwise(out)
    return out


def _zone_offset(z: Column, zone: Column) -> Column:
    """Seconds east of UTC of a zone text: an offset, or an abbreviation of the source's zone."""
    sign = F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1)
    digits = F.regexp_replace(z, "[^0-9]", "")
    offset = sign * (F.substring(digits, 1, 2).cast("int") * 3600 + F.substring(digits, 3, 2).cast("int") * 60)
    keyed = _literal_map({f"{zn}|{ab}": s for zn, abbrs in ABBREVIATIONS.items() for ab, s in abbrs.items()})
    return F.when(z.rlike(r"^[+-]\d{2}:?\d{2}$"), offset).otherwise(
        F.coalesce(F.try_element_at(keyed, F.concat_ws("|", zone, z)), F.try_element_at(keyed, F.concat(F.lit("*|"), z)))
    )


def to_epoch_us(df: DataFrame, value: str, zone: Column, date_order: Column, calendar: Calendar, out: str = "epoch_us") -> DataFrame:
    """Add `out`, the microseconds since 1970 UTC that the string column `value` denotes, or null.

    zone: IANA name for values without a zone; date_order: 'dmy' or 'mdy' for dates with slashes.
    """
    t, c, z, w = "__ts_text", "__ts_parts", "__ts_zone", "__ts_wall"
    text = F.regexp_replace(normalise_digits(F.col(value)), r"(?U)^\s+|\s+\z", "")
    patterns = [p for p in CASCADE if calendar.names or "native" not in p.groups]
    df = df.withColumn(t, text).withColumn(z, zone).withColumn("__ts_order", date_order)
    df = df.withColumn(c, F.split(_canonical(F.col(t), patterns), r"\|"))
    part = {k: F.nullif(F.get(F.col(c), F.lit(i)), F.lit("")) for i, k in enumerate(PARTS)}
    names = _literal_map({m: i + 1 for i, m in enumerate(ENGLISH_MONTHS)} | dict(calendar.names))
    first, second = part["mo"], part["d"]
    swapped = (part["kind"] == "source") & (F.col("__ts_order") != "mdy")
    month = F.when(swapped, second).otherwise(first)
    month = F.coalesce(F.when(month.rlike(r"^\d+$"), month.cast("int")), F.try_element_at(names, month), F.try_element_at(names, F.lower(F.substring(month, 1, 3))))
    df = df.withColumns({
        "__ts_y": part["y"].cast("int"), "__ts_mo": month, "__ts_d": F.when(swapped, first).otherwise(second).cast("int"),
        "__ts_h": F.coalesce(part["h"].cast("int"), F.lit(0)), "__ts_mi": F.coalesce(part["mi"].cast("int"), F.lit(0)),
        "__ts_s": F.coalesce(part["s"].cast("int"), F.lit(0)),
        "__ts_us": F.coalesce(F.rpad(F.substring(part["f"], 1, 6), 6, "0").cast("long"), F.lit(0)),
        "__ts_z": F.upper(part["z"]), "__ts_half": F.lower(part["ampm"]), "__ts_native": part["kind"] == "native",
    })
    y, mo, d, h, mi, s, us, off, half = (F.col(f"__ts_{k}") for k in ("y", "mo", "d", "h", "mi", "s", "us", "z", "half"))
    civil = F.expr("try_to_date(concat_ws('-', lpad(__ts_y, 4, '0'), lpad(__ts_mo, 2, '0'), lpad(__ts_d, 2, '0')), 'yyyy-MM-dd')")
    day = F.when(~F.col("__ts_native"), civil)
    if calendar.months:
        years = sorted({k[0] for k in calendar.months})
        table = _literal_map({y0 * 100 + m0: f"{start}|{days}" for (y0, m0), (start, days) in calendar.months.items()})
        entry = F.split(F.try_element_at(table, y * 100 + mo), r"\|")
        listed = F.when(d.between(1, entry[1].cast("int")), F.date_add(entry[0].cast("date"), d - 1))
        day = F.when(y.between(years[0], years[-1]), listed).otherwise(day)
    hour = F.when(half.isNull(), h).when(h.between(1, 12), h % 12 + F.when(half == "pm", 12).otherwise(0)).otherwise(-1)
    midnight = (h == 24) & (mi == 0) & (s == 0) & (us == 0) & half.isNull()
    ok = (hour.between(0, 23) | midnight) & mi.between(0, 59) & s.between(0, 59)
    days = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")
    df = df.withColumn(w, F.when(ok, days * 86_400_000_000 + (hour * 3600 + mi * 60 + s).cast("long") * 1_000_000 + us))
    # Wall-clock times are carried as if they were UTC. Of two instants to_utc_timestamp gives
    # the earlier; a skipped time doesn't come back as itself.
    there = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(F.col(w)), F.col(z)))
    # The row id keeps a later filter on the result from being pushed through all these steps,
    # which would copy each step's expression into the next.
    df = df.withColumns({"__ts_there": F.when(off.isNull(), there), "__ts_row": F.monotonically_increasing_id()})
    back = F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(F.col("__ts_there")), F.col(z)))
    zoned = F.when(off.isNull(), F.when(back == F.col(w), F.col("__ts_there"))).otherwise(F.col(w) - _zone_offset(off, F.col(z)).cast("long") * 1_000_000)
    unix = F.lit(None).cast("long")
    for regex, unit in UNIX:
        unix = F.when(F.col(t).rlike(regex), F.try_multiply(F.col(t).cast("long"), F.lit(unit))).otherwise(unix)
    mine = [x for x in df.columns if x.startswith("__ts_")]
    return df.withColumn(out, F.when(F.col("__ts_row") >= 0, F.coalesce(unix, zoned))).drop(*mine)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def normalise_article_times(articles: DataFrame, sites: DataFrame, calendar: Calendar) -> DataFrame:
    """One row (record_id, field, epoch_us) per readable published_date or scraped_at.

    The site is found by the url's host, since `site` may be null. `sites` is the fixed list
    of newsrooms, read through Spark's own size-checked join choice.
    """
    hosts = sites.select(F.explode("allowed_domains").alias("__host"), F.col("time_zone").alias("__tz"), F.col("date_order").alias("__order"))
    hosts = hosts.groupBy(F.lower("__host").alias("__host")).agg(F.min("__tz").alias("__tz"), F.min("__order").alias("__order"))
    rows = articles.select("record_id", host_of(F.col("url")).alias("__host"), "published_date", "scraped_at")
    rows = rows.join(hosts, "__host", "left")
    long = rows.select(
        "record_id", "__tz", "__order",
        F.explode(F.array(
            F.struct(F.lit("published_date").alias("field"), F.col("published_date").alias("value")),
            F.struct(F.lit("scraped_at").alias("field"), F.col("scraped_at").alias("value")),
        )).alias("__v"),
    ).select("record_id", "__tz", "__order", "__v.field", "__v.value").filter(F.col("value").isNotNull())
    stamp = F.when(F.col("value").rlike(r"^\s*\d{4}-?\d{2}-?\d{2}T"), "Asia/Kathmandu").otherwise("UTC")
    zone = F.when(F.col("field") == "scraped_at", stamp).otherwise(F.col("__tz"))
    out = to_epoch_us(long, "value", zone, F.coalesce(F.col("__order"), F.lit("dmy")), calendar)
    return out.filter(F.col("epoch_us").isNotNull()).select("record_id", "field", "epoch_us")
