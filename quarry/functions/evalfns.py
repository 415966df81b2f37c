"""The eval-function table (F1-F48) as Spark Column expressions.

Every function here builds a JVM-side expression (no Python UDF), so it is
code-generated inside the surrounding stage.  ANSI mode is on in Spark 4, so
lenient conversions use the ``try_*`` family: bad input gives null, not a
failed task.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# ------------------------------------------------------------- conversion
def tostring(x: ColumnOrName, fmt: str | None = None) -> Column:
    """text form; ``fmt`` is None, "commas", "hex" or "duration"."""
    x = _c(x)
    if fmt is None:
        return x.cast("string")
    if fmt == "commas":
        return F.format_number(x, 0)
    if fmt == "hex":
        return F.conv(x.cast("long").cast("string"), 10, 16)
    if fmt == "duration":
        return duration(x)
    raise ValueError(f"unsupported tostring format {fmt!r}")


def duration(seconds: ColumnOrName) -> Column:
    """Seconds as ``HH:MM:SS``, with a ``D+`` day prefix past one day."""
    s = F.floor(_c(seconds)).cast("long")
    days, rest = F.floor(s / 86400).cast("long"), F.pmod(s, F.lit(86400))
    hms = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600).cast("long"),
                          F.floor(F.pmod(rest, F.lit(3600)) / 60).cast("long"), F.pmod(rest, F.lit(60)))
    return F.when(days > 0, F.concat(days.cast("string"), F.lit("+"), hms)).otherwise(hms)


def tonumber(x: ColumnOrName) -> Column:
    """number or null (never an error)."""
    return F.trim(_c(x).cast("string")).try_cast("double")


# ---------------------------------------------------------------- strings
def upper(x): return F.upper(_c(x))                                   # F3
def lower(x): return F.lower(_c(x))                                   # F4
def len_(x): return F.length(_c(x))                                   # F5
def trim(x): return F.trim(_c(x))                                     # F23
def ltrim(x): return F.ltrim(_c(x))                                   # F24
def rtrim(x): return F.rtrim(_c(x))                                   # F25


def substr(x: ColumnOrName, start: int, length: int | None = None) -> Column:
    """1-based substring."""
    if length is None:
        return F.substring(_c(x), start, 2147483647)
    return F.substring(_c(x), start, length)


def replace(x: ColumnOrName, pattern: str, repl: str) -> Column:
    """regex replace of every match."""
    return F.regexp_replace(_c(x), pattern, repl)


def split(x: ColumnOrName, delim: str) -> Column:
    """split on a literal delimiter (quoted, since Spark splits on regex)."""
    return F.split(_c(x), re.escape(delim))


def mvjoin(x: ColumnOrName, delim: str) -> Column:
    return F.array_join(_c(x), delim)                                 # F28


def contains(x: ColumnOrName, y) -> Column:
    return F.contains(_c(x), _lit(y))                                 # F29


def concat_str(*xs) -> Column:
    """string ``+``; Columns are operands, plain values are literals;
    any null operand gives null."""
    return F.concat(*[x.cast("string") if isinstance(x, Column) else F.lit(str(x)) for x in xs])


# ------------------------------------------------------------- conditions
def if_(cond: Column, a, b) -> Column:
    return F.when(cond, _lit(a)).otherwise(_lit(b))                   # F9


def case(*args) -> Column:
    """``case(c1, v1, c2, v2, ..., [default])`` - first true wins."""
    pairs = list(args)
    default = pairs.pop() if len(pairs) % 2 == 1 else None
    out = None
    for cond, val in zip(pairs[0::2], pairs[1::2]):
        out = F.when(cond, _lit(val)) if out is None else out.when(cond, _lit(val))
    if out is None:
        return _lit(default)
    return out.otherwise(_lit(default)) if default is not None else out


def isnotnull(x): return _c(x).isNotNull()                            # F11
def isnull(x): return _c(x).isNull()                                  # F12
def coalesce(*xs): return F.coalesce(*[_c(x) for x in xs])            # F13
def eq(x, y): return _c(x) == _lit(y)                                 # F16


def add(x, y) -> Column:
    """numeric ``+`` without overflow errors (null instead)."""
    return F.try_add(_c(x), _c(y) if isinstance(y, (str, Column)) else F.lit(y))


# ------------------------------------------------------------ multivalue
def mvcount(x: ColumnOrName) -> Column:
    """number of values; null for a null field."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.size(x))


def mvindex(x: ColumnOrName, i: int) -> Column:
    """0-based element, null outside the array."""
    return F.get(_c(x), i)


# ------------------------------------------------------------------ math
def abs_(x): return F.abs(_c(x))                                      # F30
def ceil(x): return F.ceil(_c(x))                                     # F31
def floor(x): return F.floor(_c(x))                                   # F32
def round_(x, n: int = 0): return F.round(_c(x), n)                   # F33 (half up)
def sqrt(x): return F.sqrt(_c(x))                                     # F34
def power(x, y): return F.power(_c(x), _lit(y))                       # F35
def random(seed: int = 0): return F.rand(seed)                        # F36
def max_(*xs): return F.greatest(*[_c(x) for x in xs])                # F37 (skips nulls)
def min_(*xs): return F.least(*[_c(x) for x in xs])                   # F38


def sigfig(x: ColumnOrName, digits: int = 3) -> Column:
    """round to ``digits`` significant figures."""
    x = _c(x).cast("double")
    scale = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    p = F.power(F.lit(10.0), scale)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * p) / p)


def exact(x: ColumnOrName) -> Column:
    """exact arithmetic is the double itself here."""
    return _c(x).cast("double")


# ------------------------------------------------------------------ time
# Strftime codes and their Java DateTimeFormatter equivalents.
STRFTIME_CODES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh",
    "%M": "mm", "%S": "ss", "%p": "a", "%A": "EEEE", "%a": "EEE", "%B": "MMMM", "%b": "MMM",
}


def java_pattern(fmt: str) -> str:
    """Translate a strftime format to a Java pattern; other text is quoted."""
    out, literal, i = [], [], 0
    while i < len(fmt):
        code = fmt[i:i + 2]
        if code in STRFTIME_CODES:
            if literal:
                out.append("'" + "".join(literal).replace("'", "''") + "'")
                literal = []
            out.append(STRFTIME_CODES[code])
            i += 2
        elif code == "%%":
            literal.append("%")
            i += 2
        else:
            literal.append(fmt[i])
            i += 1
    if literal:
        out.append("'" + "".join(literal).replace("'", "''") + "'")
    return "".join(out)


def strftime(epoch_seconds: ColumnOrName, fmt: str) -> Column:
    """format epoch seconds with a strftime pattern (UTC session)."""
    return F.date_format(F.timestamp_seconds(_c(epoch_seconds)), java_pattern(fmt))


def strptime(s: ColumnOrName, fmt: str) -> Column:
    """F8: parse text with a strftime pattern to epoch seconds (null if bad)."""
    return F.unix_timestamp(F.try_to_timestamp(_c(s), F.lit(java_pattern(fmt))))


def now() -> Column:
    return F.unix_timestamp()                                         # F22


def epoch(ts: ColumnOrName) -> Column:
    """Epoch seconds of a timestamp (NTZ values are read as UTC)."""
    return F.unix_timestamp(_c(ts).cast("timestamp"))


# --------------------------------------------------------- url and hashes
def urlencode(x): return F.url_encode(_c(x))                          # F39
def urldecode(x): return F.try_url_decode(_c(x))                      # F40
def md5(x): return F.md5(_c(x).cast("binary"))                        # F42


def sha(x: ColumnOrName, bits: int = 256) -> Column:
    """sha1 (bits=1) or sha2-224/256/384/512."""
    x = _c(x).cast("binary")
    return F.sha1(x) if bits == 1 else F.sha2(x, bits)


# ------------------------------------------------------------------ JSON
def json_extract(x: ColumnOrName, path: str) -> Column:
    return F.get_json_object(_c(x), path)                             # F47


def json_valid(x: ColumnOrName) -> Column:
    """true for JSON documents, false for plain text, null for null."""
    x = _c(x)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.try_parse_json(x).isNotNull())


# ------------------------------------------------------------ searchmatch
# Fixed value: what counts as one search term.
TERM_PATTERN = r"[\p{L}\p{N}_]+(?:'[\p{L}\p{N}_]+)*"


def terms_of(text: ColumnOrName) -> Column:
    """Lower-cased search terms of a text, in order."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(TERM_PATTERN), 0)


def searchmatch(text: ColumnOrName, query: str) -> Column:
    """every term of ``query`` occurs as a term of ``text``."""
    q = [t.lower() for t in re.findall(r"[\w]+(?:'[\w]+)*", query, flags=re.UNICODE)]
    if not q:
        raise ValueError("query contains no search terms")
    toks = terms_of(text)
    return F.size(F.array_except(F.array(*[F.lit(t) for t in q]), toks)) == 0


def eval_columns(df, exprs: dict) -> "DataFrame":  # noqa: F821
    """Add named expressions in order (later ones may read earlier ones)."""
    for name, expr in exprs.items():
        df = df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)
    return df


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("re", "Sequence", "Column", "F")]
