"""Column expressions on indicator values, identities, times and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m

WHITESPACE = " \t\n\r\x0b\x0c"

# Fixed patterns: the accepted spellings of a defanged value and of the declared window.
DEFANGED_SCHEME = "h[xX]{2}p"
DEFANGED_DOTS = ("[.]", "(.)", "{.}")
DEFANGED_COLON = "[:]"
DEFANGED_SEPARATOR = "[://]"
DECLARED_WINDOW = r"^P(\d+)D/"

DAY_SECONDS = 86_400
LONGEST = 9_223_372_036_854_775_807


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def refang(value: Column) -> Column:
    """Undo the usual obfuscations; the scheme rule is case-sensitive on its ``h`` and ``p``."""
    # Hardly any value has the scheme; looking for it is far cheaper than the pattern.
    out = F.when(F.lower(value).contains("hxxp"), F.regexp_replace(value, DEFANGED_SCHEME, "http")).otherwise(value)
    for dot in DEFANGED_DOTS:
        out = F.replace(out, F.lit(dot), F.lit("."))
    out = F.replace(out, F.lit(DEFANGED_COLON), F.lit(":"))
    return F.replace(out, F.lit(DEFANGED_SEPARATOR), F.lit("://"))


def normalize_value(kind: Column, value: Column) -> Column:
    """Stored form of a value: trimmed and refanged, then lower case and no final dots by type."""
    clean = refang(strip(value))
    return (
        F.when(kind == m.DOMAIN, F.rtrim(F.lower(clean), F.lit(".")))
        .when(kind.isin(*m.LOWERCASE_TYPES), F.lower(clean))
        .otherwise(clean)
    )


def canonical_key(kind: Column, value: Column) -> Column:
    """Identity of an indicator across sources (normalised value, no separators)."""
    return F.sha2(F.concat(kind, value), 256)


def record_id(kind: Column, value: Column, source: Column) -> Column:
    """Identity of one source's record of an indicator."""
    return F.sha2(F.concat(kind, value, source), 256)


def defang(kind: Column, value: Column) -> Column:
    """Report form: unclickable for addresses, domains and URLs; other types unchanged."""
    unlinked = F.regexp_replace(value, r"(?i)^http(s?)://", "hxxp$1://")
    return F.when(
        kind.isin(*m.DEFANGED_TYPES), F.replace(unlinked, F.lit("."), F.lit("[.]"))
    ).otherwise(value)


def parse_datetime(text: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` with an optional `` UTC`` suffix; NULL when illegible."""
    stripped = strip(text)
    bare = F.when(stripped.endswith(" UTC"), strip(F.substring(stripped, F.lit(1), F.length(stripped) - 4))).otherwise(stripped)
    shaped = bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    return F.when(shaped, F.try_to_timestamp(bare))


def parse_date(text: Column) -> Column:
    """``YYYY-MM-DD`` as a date; NULL when illegible."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d")))


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` at midnight UTC; NULL when illegible."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d"))


TIME_PARSERS = {"date": parse_day, "datetime": parse_datetime}


def has_text(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole and fractional seconds as DOUBLE; an interval compared strictly must not be cut."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def whole_number(text: Column, most: int) -> Column:
    """The number cut to its whole part if that is 0 to ``most``; NULL for any other text.

    Compared as a double first, so that no text a feed may send overflows.
    """
    number = F.trim(text).try_cast("double")
    return F.when((number > -1) & (number < most + 1), number.cast("int"))


def declared_window_seconds(window: Column) -> Column:
    """Seconds of a run's declared window.

    Absent means no ceiling (NULL). Illegible means zero: dropping the ceiling in silence would
    publish what the ceiling exists to hold back. A window of more days than a whole number holds
    is longer than any interval and counts as the longest that can be written.
    """
    days = F.regexp_extract(window, DECLARED_WINDOW, 1)
    seconds = F.try_multiply(days.try_cast("bigint"), F.lit(DAY_SECONDS))
    return (
        F.when(~has_text(window), F.lit(None).cast("bigint"))
        .when(days == "", F.lit(0).cast("bigint"))
        .otherwise(F.coalesce(seconds, F.lit(LONGEST)))
    )


def confidence_band(confidence: Column) -> Column:
    band = F.lit(None).cast("string")
    for lower, name in reversed(m.CONFIDENCE_BANDS):
        band = F.when(confidence >= lower, F.lit(name)).otherwise(band)
    return band


def is_trivial(value: Column) -> Column:
    """True for digests of the empty file, in any case."""
    return F.lower(value).isin(*m.TRIVIAL_DIGESTS)


# --- ip:port -------------------------------------------------------------------------------


def _ipv6_groups(address: Column) -> Column:
    """The address with a dotted IPv4 tail written as the two groups it stands for."""
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    dotted = rf"^(.*:){octet}\.{octet}\.{octet}\.{octet}$"
    a, b, c, e = (F.regexp_extract(address, dotted, i).cast("int") for i in range(2, 6))
    return F.when(
        address.contains(".") & address.rlike(dotted),
        F.format_string("%s%x:%x", F.regexp_extract(address, dotted, 1), a * 256 + b, c * 256 + e),
    ).otherwise(address)


def with_ipv6_text(df: DataFrame, host: str, into: str) -> DataFrame:
    """Adds the shortest lower-case text of the IPv6 address in ``host``, NULL if it is none.

    Steps are columns of their own, each read several times by the next one, so nothing is
    evaluated twice; rows never leave the JVM.
    """
    step = [f"_{into}_{i}" for i in range(5)]
    text, padded, full, plain, ends = (F.col(name) for name in step)
    kept = df.columns

    # A lone colon at either end, or more than one "::", is no address.
    shape = r"^(?!:[^:])(?!.*[^:]:$)(?!.*:::)(?!.*::.+::)[0-9a-fA-F:.]+$"
    address = F.substring_index(F.col(host), "%", 1)
    scoped = F.col(host).contains("%")
    scope = F.when(scoped, F.regexp_extract(F.col(host), r"^[^%]*(%[^%/]+)$", 1)).otherwise(F.lit(""))
    df = df.select(
        *kept,
        F.when(address.rlike(shape), F.lower(_ipv6_groups(address))).alias(step[0]),
        F.when(~scoped | (scope != ""), scope).alias(step[4]),
    )
    # With a zero group at an open end, "::" always stands between two groups.
    edge = F.when(text.startswith("::"), F.concat(F.lit("0"), text)).otherwise(text)
    edge = F.when(text.endswith("::"), F.concat(edge, F.lit("0"))).otherwise(edge)
    df = df.select("*", edge.alias(step[1]))
    # Then there are as many groups as colons; "::" stands for those missing to eight.
    colons = F.length(padded) - F.length(F.replace(padded, F.lit(":"), F.lit("")))
    open_end = (padded != text).cast("int")
    zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.greatest(F.lit(8) - colons, F.lit(0))))
    written = F.when(
        F.instr(padded, "::") > 0,
        F.when(colons <= 7 + open_end, F.replace(padded, F.lit("::"), zeros)),
    ).otherwise(padded)
    df = df.select("*", written.alias(step[2]))
    eight = full.rlike(r"^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$")
    stripped = F.regexp_replace(full, r"(^|:)0+(?=[0-9a-f])", "$1")
    df = df.select("*", F.when(eight, F.concat(F.lit(":"), stripped, F.lit(":"))).alias(step[3]))
    # Squeeze the longest run of two or more zero groups, the first one if several are as long.
    short = F.substring(plain, 2, 39 + 2)
    short = F.rtrim(short, F.lit(":"))
    for run in range(2, 9):
        zeros_run = ":" + "0:" * run
        at = F.instr(plain, zeros_run)
        head = F.ltrim(F.substring(plain, F.lit(1), at - 1), F.lit(":"))
        tail = F.rtrim(F.substring(plain, at + len(zeros_run), F.lit(64)), F.lit(":"))
        short = F.when(at > 0, F.concat(head, F.lit("::"), tail)).otherwise(short)
    return df.select(*kept, F.concat(short, ends).alias(into))


def with_ip_port(df: DataFrame, text: str, kind: str, host: str) -> DataFrame:
    """Adds type and host of an ``ip:port`` value.

    ``[v6]:port`` and bare v6 give an IPv6 in its shortest text (NULL host if illegible); else
    the part before the last colon is taken as an IPv4 without further checks.
    """
    kept = df.columns
    bare = F.col("_bare")
    df = df.withColumn("_bare", strip(F.col(text)))
    bracketed = bare.startswith("[")
    inner = F.regexp_replace(bare, r"^\[([^\]]*)(\].*)?$", "$1")
    v6 = bracketed | F.regexp_like(bare, F.lit(":.*:"))
    before_port = F.regexp_replace(bare, r":[^:]*$", "")
    df = df.select(
        *kept,
        F.when(v6, F.lit(m.IPV6)).when(bare.isNotNull(), F.lit(m.IPV4)).alias(kind),
        F.when(v6, F.when(bracketed, inner).otherwise(bare)).alias("_v6_host"),
        F.when(~v6, F.when(before_port == "", bare).otherwise(before_port)).alias("_v4_host"),
    )
    df = with_ipv6_text(df, "_v6_host", "_v6_text")
    return df.select(*kept, kind, F.coalesce("_v4_host", "_v6_text").alias(host))


def indicator_type(label: Column) -> Column:
    """Indicator type of a feed type label; NULL when the schema has none for it."""
    out = F.lit(None).cast("string")
    for name, kind in reversed(m.IOC_TYPES.items()):
        out = F.when(label == name, F.lit(kind)).otherwise(out)
    return out
