"""Text scalars: Column in, Column out, all JVM-side.

White space is the ASCII set (space, tab, line feed, return, form feed, vertical tab) everywhere, so
results do not depend on an engine's Unicode tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[ \t\n\r\f\x0B]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value), with the value computed once a row: lambdas inside see a variable, not an expression to repeat."""
    return F.element_at(F.transform(F.array(value), use), 1)


def safe(c) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(col(c), F.lit(""))


def strip(c) -> Column:
    return F.regexp_replace(col(c), rf"^{WS}+|{WS}+$", "")


def rstrip(c) -> Column:
    return F.regexp_replace(col(c), rf"{WS}+$", "")


def lstrip(c) -> Column:
    return F.regexp_replace(col(c), rf"^{WS}+", "")


def collapse(c) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(col(c), rf"{WS}+", " ")


def normalize(c, strip_: bool = True, collapse_: bool = True, lower: bool = True) -> Column:
    """Strip, collapse white space, lower-case; each step optional."""
    out = safe(c)
    if strip_:
        out = strip(out)
    if collapse_:
        out = collapse(out)
    return F.lower(out) if lower else out


def sha256(c) -> Column:
    return F.sha2(col(c).cast("binary"), 256)


def short_id(c, n: int = 24) -> Column:
    """The first n hex digits of SHA-256: the id of content-addressed rows."""
    return F.left(sha256(c), F.lit(n))


def document_id(url, content_hash) -> Column:
    return short_id(F.concat(col(url), col(content_hash)))


def text_sha1(c) -> Column:
    """SHA-1 of the text with white space collapsed, lower-cased: equal for texts that differ in layout only."""
    return F.sha1(F.lower(collapse(strip(safe(c)))))


def first_line(c) -> Column:
    """A title for texts that come without one."""
    return strip(F.element_at(F.split(safe(c), "\n", 2), 1))


def tokenize(c) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(safe(c)), F.lit("[a-z0-9]+"), F.lit(0))


def with_title(title, text, separator: str = " ") -> Column:
    """Title and text, or the text alone where the title is blank."""
    t = strip(safe(title))
    return F.when(t == "", safe(text)).otherwise(F.concat(t, F.lit(separator), safe(text)))


def truncate(c, limit: int, mark: str = "…") -> Column:
    """At most `limit` characters of the stripped text, then the mark if any were cut."""
    t = strip(safe(c))
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(rstrip(F.left(t, F.lit(limit))), F.lit(mark)))


def header_text(headers: Column, content) -> Column:
    """`k:v, k:v` of a map on a line of its own before the content; nothing for an empty map."""
    entries = F.filter(F.map_entries(headers), lambda e: strip(safe(e["value"])) != "")
    line = F.array_join(F.transform(F.array_sort(entries), lambda e: F.concat(e["key"], F.lit(":"), strip(e["value"]))), ", ")
    body = strip(safe(content))
    return F.when(F.size(entries) > 0, F.concat(line, F.lit("\n"), body)).otherwise(body)


def smart_join(a, b) -> Column:
    """a and b with one space between, or the one that is not empty."""
    x, y = rstrip(safe(a)), lstrip(safe(b))
    return F.when(x == "", y).when(y == "", x).otherwise(F.concat(x, F.lit(" "), y))


def overlap_matches(cur, nxt, n: int) -> Column:
    """Whether the last n characters of cur are the first n of nxt; an overlap of 0 always matches."""
    if n <= 0:
        return F.lit(True)
    a, b = safe(cur), safe(nxt)
    return (F.length(a) >= n) & (F.length(b) >= n) & (F.right(a, F.lit(n)) == F.left(b, F.lit(n)))


def count_chars(c, chars: str) -> Column:
    """How many characters of c are among chars."""
    return F.length(safe(c)) - F.length(F.translate(safe(c), chars, ""))


def contains_any(c, needles: list[str]) -> Column:
    """Whether any needle occurs, in either case."""
    low, out = F.lower(safe(c)), F.lit(False)
    for n in needles:
        if n:
            out = out | F.contains(low, F.lit(n.lower()))
    return out


def clamp(c, low: float = 0.0, high: float = 1.0, default: float = 0.0) -> Column:
    """A number within bounds from anything that can be cast; else the default."""
    x = col(c).try_cast("double")
    return F.greatest(F.least(F.coalesce(F.when(F.isnan(x), None).otherwise(x), F.lit(default)), F.lit(high)), F.lit(low))


def iso_z(ts) -> Column:
    """A timestamp as ISO-8601 text with Z (session in UTC)."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_ms(ts) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))


def query_text(c, min_chars: int, max_chars: int) -> Column:
    """A query cut to max_chars, stripped; null if it was shorter than min_chars."""
    t = strip(safe(c))
    return F.when(F.length(t) >= min_chars, strip(F.left(t, F.lit(max_chars))))


def instructed(instruction: str, c) -> Column:
    """The text an encoder sees: an instruction line first, if there is one."""
    return F.concat(F.lit(instruction + "\n"), safe(c)) if instruction.strip() else safe(c)
