"""Scalar column functions.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- hashing
def stable_hash(x) -> Column:
    """first 8 hex digits of MD5 of the text form, as a bigint in [0, 2^32)."""
    return F.conv(F.substring(F.md5(_c(x).cast("string")), 1, 8), 16, 10).cast("bigint")


def pseudonym(x, n: int = 12) -> Column:
    """first ``n`` hex digits of SHA-256 of the text form."""
    return F.substring(F.sha2(_c(x).cast("string"), 256), 1, n)


# ---------------------------------------------------------------- lists / text
def split_list(x, sep: str = ";") -> Column:
    """``a;b`` -> [a, b]; empty text -> empty list; null stays null."""
    c = _c(x)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, re.escape(sep)))


def join_list(x, sep: str = ";") -> Column:
    """list -> ``a;b``; empty list -> ''."""
    return F.array_join(_c(x), sep)


def default_text(x, default: str = "(no title)") -> Column:
    """empty or null text -> default."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default))


def empty_to_null(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def last_path_element(x) -> Column:
    """text after the last ``/``."""
    return F.element_at(F.split(_c(x), "/"), -1)


def prefixed_id(prefix: str, x) -> Column:
    """``a/<id>``."""
    return F.concat(F.lit(prefix), _c(x).cast("string"))


def strip_prefix(prefix: str, x) -> Column:
    """inverse of :func:`prefixed_id`; rows without the prefix give null."""
    c = _c(x)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1)))


def client_from_user_agent(x) -> Column:
    """``PhotosApp/<v> (iOS ...)`` -> ``ios/<v>``, Android likewise, browsers -> ``web``."""
    c = _c(x)
    ver = F.regexp_extract(c, r"PhotosApp/(\S+)", 1)
    return (F.when(c.contains("PhotosApp/") & c.rlike("(?i)ios|iphone"), F.concat(F.lit("ios/"), ver))
            .when(c.contains("PhotosApp/"), F.concat(F.lit("android/"), ver))
            .otherwise(F.lit("web")))


def round2(x) -> Column:
    """round to 2 decimals as ``round(100 x) / 100`` (identical in DuckDB, §7.1)."""
    return F.round(_c(x) * F.lit(100.0), 0) / F.lit(100.0)


def ratio2(num, den) -> Column:
    """Rounded share ``num / den`` computed as ``round(100.0 * num / den) / 100``."""
    return F.round(F.lit(100.0) * _c(num) / _c(den), 0) / F.lit(100.0)


# ---------------------------------------------------------------- time
def month_text(ts) -> Column:
    """``yyyy-MM``."""
    return F.date_format(_c(ts), "yyyy-MM")


def day_text(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def floor_hours(ts, hours: int = 6) -> Column:
    """floor to ``hours`` on the epoch grid (as ``window(ts, '6 hours').start``)."""
    micros = F.unix_micros(_c(ts).cast("timestamp"))
    step = hours * 3600 * 1_000_000
    return F.timestamp_micros(F.floor(micros / step).cast("bigint") * step).cast("timestamp_ntz")


def hour_key(iso_text) -> Column:
    """first 13 characters of the ISO text, ``yyyy-MM-ddTHH``."""
    return F.substring(_c(iso_text), 1, 13)


def iso_millis(ts) -> Column:
    """ISO-8601 text with milliseconds (truncated) and ``Z``."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_millis(ts) -> Column:
    """milliseconds since the epoch."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_micros(ts) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def epoch_nanos(ts) -> Column:
    """nanoseconds since the epoch (micro precision)."""
    return F.unix_micros(_c(ts).cast("timestamp")) * F.lit(1000)


def access_time(text) -> Column:
    """F8: access-log time ``dd/MMM/yyyy:HH:mm:ss Z`` to a UTC timestamp_ntz (null if bad)."""
    return F.try_to_timestamp(_c(text), F.lit("dd/MMM/yyyy:HH:mm:ss Z")).cast("timestamp_ntz")


# The six time layouts of the log files, tried in this order
# (pattern holding the time in group 1, Spark datetime pattern; None = ISO cast).
LOG_TIME_FORMATS = [
    (r"\[(\d\d/\w{3}/\d{4}:\d\d:\d\d:\d\d) \+0000\]", "dd/MMM/yyyy:HH:mm:ss"),
    (r"^(\d{4}/\d\d/\d\d \d\d:\d\d:\d\d) \[", "yyyy/MM/dd HH:mm:ss"),
    (r'"(?:ts|received)": "([^"]+)Z"', None),
    (r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d,\d{3}) ", "yyyy-MM-dd HH:mm:ss,SSS"),
    (r"^time=(\S+)Z ", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^(\w{3} [ \d]\d \d\d:\d\d:\d\d) ", "syslog"),
]


def log_time(line, syslog_year: int = 2021) -> Column:
    """timestamp of a log line, first matching layout wins; syslog gets ``syslog_year``.

    A line that matches no layout (or whose time does not parse) gives null
    (PERMISSIVE); :func:`log_time_strict` fails the job instead (FAILFAST).
    """
    c = _c(line)
    expr = None
    for pattern, fmt in LOG_TIME_FORMATS:
        text = F.regexp_extract(c, pattern, 1)
        if fmt is None:
            parsed = F.try_to_timestamp(text)
        elif fmt == "syslog":
            norm = F.concat(F.lit(f"{syslog_year} "), F.regexp_replace(text, r"\s+", " "))
            parsed = F.try_to_timestamp(norm, F.lit("yyyy MMM d HH:mm:ss"))
        else:
            parsed = F.try_to_timestamp(text, F.lit(fmt))
        cond = c.rlike(pattern)
        expr = F.when(cond, parsed) if expr is None else expr.when(cond, parsed)
    return expr.cast("timestamp_ntz")


def log_time_strict(line, syslog_year: int = 2021) -> Column:
    """F7 FAILFAST: like :func:`log_time` but a line without a time raises an error."""
    t = log_time(line, syslog_year)
    return F.when(t.isNull(), F.raise_error(F.concat(F.lit("line carries no known time: "), F.substring(_c(line), 1, 80)))) \
        .otherwise(t).cast("timestamp_ntz")


# ---------------------------------------------------------------- log parsers
# Fixed value: the common access-log format.
ACCESS_RE = r'^(\S+) - (\S+) \[([^\]]+)\] "(\S+) (\S+) [^"]*" (\d{3}) (\d+)'


def parse_access(line) -> Column:
    """access-log fields ip, user, time, method, path, status (size parsed, not kept)."""
    # the pattern runs once per line: its seven fields, or the whole line as the eighth; a field holds no " ]",
    # as only the time may hold spaces and it ends before a "]", and the first one is never empty
    either = f"(?s)^(?:{ACCESS_RE[1:]}.*|(.*))$"
    parts = F.split(F.regexp_replace(_c(line), either, " ]".join(f"${i}" for i in range(1, 9))), " \\]")
    ok = F.coalesce((F.size(parts) >= 8) & (F.get(parts, F.lit(0)) != ""), F.lit(False))
    g = lambda i: F.when(ok, F.get(parts, F.lit(i - 1))).otherwise(F.lit(""))
    return F.struct(
        g(1).alias("ip"), g(2).alias("user"), access_time(g(3)).alias("time"),
        g(4).alias("method"), g(5).alias("path"), g(6).try_cast("int").alias("status"),
        ok.alias("is_parsed"))


def parse_access_strict(line) -> Column:
    """Q12 FAILFAST: the access-log fields, raising an error on a line that does not match."""
    r = parse_access(line)
    return F.when(~r["is_parsed"], F.raise_error(F.concat(F.lit("not an access-log line: "),
                                                         F.substring(_c(line), 1, 80)))).otherwise(r)


def field(line, n: int) -> Column:
    """whitespace field ``$n`` (1-based) like awk; missing -> null."""
    return F.try_element_at(F.split(F.trim(_c(line)), r"\s+"), F.lit(n))


def n_fields(line) -> Column:
    return F.size(F.split(F.trim(_c(line)), r"\s+"))


def pattern_to_regex(pattern: str) -> tuple[str, list[str]]:
    """compile a ``<name>`` / ``<_>`` pattern into a regex and the ordered field names."""
    names, out, pos = [], [], 0
    for m in re.finditer(r"<(\w+)>", pattern):
        out.append(re.escape(pattern[pos:m.start()]))
        if m.group(1) == "_":
            out.append(".*?")
        else:
            names.append(m.group(1))
            out.append("(.*?)")
        pos = m.end()
    tail = pattern[pos:]
    out.append(re.escape(tail) if tail else "")
    return "".join(out), names


def parse_pattern(line, pattern: str) -> Column:
    """fields of ``pattern`` extracted from ``line`` as a struct (unmatched -> '')."""
    rx, names = pattern_to_regex(pattern)
    c = _c(line)
    return F.struct(*[F.regexp_extract(c, rx, i + 1).alias(n) for i, n in enumerate(names)])


def parse_regexp(line, regex: str, names: list[str]) -> Column:
    """groups of ``regex`` as named struct fields (unmatched -> '')."""
    c = _c(line)
    return F.struct(*[F.regexp_extract(c, regex, i + 1).alias(n) for i, n in enumerate(names)])


LOGFMT_RE = r'([\w.\-]+)=("(?:[^"\\]|\\.)*"|\S*)'


def _last_wins(keys: Column, vals: Column) -> Column:
    """Map of two arrays; of a repeated key the last value stays."""
    at = F.filter(F.sequence(F.lit(0), F.size(keys) - 1),
                  lambda i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), F.get(keys, i)))
    at = F.when(F.size(keys) > 0, at).otherwise(F.array().cast("array<int>"))
    return F.map_from_arrays(F.transform(at, lambda i: F.get(keys, i)), F.transform(at, lambda i: F.get(vals, i)))


def logfmt(line) -> Column:
    """``k=v k="quoted text"`` -> map<string,string>; quotes removed, ``\\"`` unescaped, dotted keys kept,
    the last value of a repeated key wins."""
    c = _c(line)
    keys = F.regexp_extract_all(c, F.lit(LOGFMT_RE), 1)
    vals = F.transform(F.regexp_extract_all(c, F.lit(LOGFMT_RE), 2),
                       lambda v: F.when(v.startswith('"'), F.regexp_replace(F.regexp_replace(v, r'^"|"$', ""), r"\\(.)", "$1")).otherwise(v))
    return _last_wins(keys, vals)


def report_to_map(text) -> Column:
    """lines ``name=number`` of a report -> map<string,bigint>; the last line of a repeated name wins,
    a number beyond 64 bits gives null."""
    c = _c(text)
    rx = r"(?m)^\s*([^=\n]+?)=(\d+)\s*$"
    keys = F.regexp_extract_all(c, F.lit(rx), 1)
    vals = F.transform(F.regexp_extract_all(c, F.lit(rx), 2), lambda v: v.try_cast("bigint"))
    return _last_wins(keys, vals)


def int_fields(json_text) -> Column:
    """keys of a JSON object whose value is an integer (by JSON type: text and fractions are none)
    -> map<string,bigint>; integers beyond 64 bits are left out."""
    m = F.map_entries(F.try_variant_get(F.try_parse_json(_c(json_text)), "$", "map<string,variant>"))
    ints = F.filter(m, lambda e: F.schema_of_variant(e["value"]) == "BIGINT")
    return F.map_from_entries(F.transform(ints, lambda e: F.struct(
        e["key"].alias("key"), F.try_variant_get(e["value"], "$", "bigint").alias("value"))))


# ---------------------------------------------------------------- URLs
def url_param(url, name: str) -> Column:
    """decoded value of query parameter ``name``; last duplicate wins; absent -> null."""
    q = F.try_parse_url(_c(url), F.lit("QUERY"))
    vals = F.regexp_extract_all(F.concat(F.lit("&"), q), F.lit(rf"&{re.escape(name)}=([^&#]*)"), 1)
    last = F.try_element_at(vals, F.lit(-1))
    return F.try_url_decode(F.regexp_replace(last, r"\+", " "))


def url_encode(x) -> Column:
    """percent-encode everything but the RFC 3986 unreserved characters (space -> %20)."""
    e = F.url_encode(_c(x))
    return F.replace(F.replace(F.replace(e, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")),
                     F.lit("%7E"), F.lit("~"))


# Ordered routes of the gateway; only GET is routed, first match
# wins, anything else is 404.
ROUTES = [
    (r"^/api/photos/(\d+)$", "photo"),
    (r"^/api/photos/(\d+)/keywords$", "keywords"),
    (r"^/api/search$", "search"),
]


def route_class(method, path) -> Column:
    """route name by ordered patterns for GET; anything else -> 'not_found' (404)."""
    m, p = _c(method), _c(path)
    expr = None
    for rx, name in ROUTES:
        cond = (m == "GET") & p.rlike(rx)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("not_found"))


def route_id(path) -> Column:
    """Photo id of a photo or keywords route ('' otherwise)."""
    return F.regexp_extract(_c(path), r"^/api/photos/(\d+)(?:/keywords)?$", 1)
