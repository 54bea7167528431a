"""Addresses and the text of pages as column expressions: entities, references resolved against a base, percent codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a reference (scheme, authority, path, query, fragment), and named entities.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&amp;": "&"}


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where use names the value several times and it is to be computed once: an array of one, transformed."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _each(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """text with every match of the pattern changed."""

    def changed(t: Column) -> Column:
        found, gaps = F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.split(t, pattern, -1)
        parts = F.zip_with(gaps, found, lambda gap, m: F.concat(gap, F.coalesce(change(m), F.lit(""))))
        return F.when(t.rlike(pattern), F.array_join(parts, "")).otherwise(t)

    return _once(text, changed)


def unescaped(text: Column) -> Column:
    """Entities undone: named ones of XML, and numbers, decimal or hexadecimal; each once."""

    def character(m: Column) -> Column:
        digits = F.regexp_extract(m, "(?i)^&#x?([0-9a-f]+);$", 1)
        hexadecimal = F.when(m.rlike("(?i)^&#x"), digits).otherwise(F.conv(digits, 10, 16))
        valid = (F.length(hexadecimal) <= 6) & (F.conv(hexadecimal, 16, 10).cast("long") <= 0x10FFFF) & ~hexadecimal.rlike("(?i)^0*d[89a-f][0-9a-f]{2}$")
        return F.when(valid, F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32")).otherwise(m)

    named = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    either = "(?i)&#x[0-9a-f]{1,8};|&#[0-9]{1,9};|" + "|".join(ENTITIES)
    return _each(text, either, lambda m: F.when(F.startswith(m, F.lit("&#")), character(m)).otherwise(F.coalesce(F.element_at(named, F.lower(m)), m)))


def encoded(text: Column) -> Column:
    """White space and what isn't ASCII as percent codes."""
    return _each(text, r"[^\x21-\x7E]+", lambda m: F.replace(F.url_encode(m), F.lit("+"), F.lit("%20")))


def decoded(text: Column) -> Column:
    """Percent codes undone; null where they are none. A plus stays."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def without_dots(path: Column) -> Column:
    """A path without the segments . and .. (RFC 3986, 5.2.4)."""
    return _once(path, _without_dots)


def _without_dots(path: Column) -> Column:
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1)
    none = F.array().cast("array<string>")
    absolute = F.startswith(path, F.lit("/"))
    # Nothing is taken away beyond the root.
    step = lambda a, s: F.when(s == ".", a).when(s == "..", F.when(F.size(a) > F.when(absolute, 1).otherwise(0), F.slice(a, 1, F.size(a) - 1)).otherwise(a)).otherwise(F.concat(a, F.array(s)))
    kept = F.aggregate(segments, none, step)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")).otherwise(path)


def resolved(base: Column, reference: Column) -> Column:
    """A reference against a base address (RFC 3986, 5.2), scheme and authority in lower case, encoded. An empty query or
    fragment counts as none."""
    parts = lambda x: F.array(*[F.regexp_extract(x, _PARTS, k) for k in range(1, 6)])
    return _once(F.struct(parts(base).alias("b"), parts(F.trim(reference)).alias("r")), lambda x: _resolved(*[[F.get(x[c], F.lit(k)) for k in range(5)] for c in "br"]))


def _resolved(b: list[Column], r: list[Column]) -> Column:
    has = lambda x: F.length(x) > 0
    directory = F.regexp_extract(b[2], r"^(.*/)", 1)
    merged = F.when(has(b[1]) & ~has(b[2]), F.concat(F.lit("/"), r[2])).otherwise(F.concat(directory, r[2]))
    own = has(r[0]) | has(r[1])
    path = F.when(own | F.startswith(r[2], F.lit("/")), without_dots(r[2])).when(has(r[2]), without_dots(merged)).otherwise(b[2])
    path = _once(path, lambda p: F.when(has(F.when(own, r[1]).otherwise(b[1])) & ~has(p), "/").otherwise(p))
    query = F.when(own | has(r[2]) | has(r[3]), r[3]).otherwise(b[3])
    authority = F.lower(F.when(own, r[1]).otherwise(b[1]))
    part = lambda before, x: F.when(has(x), F.concat(F.lit(before), x)).otherwise("")
    scheme = F.lower(F.when(has(r[0]), r[0]).otherwise(b[0]))
    return encoded(F.concat(scheme, F.lit(":"), part("//", authority), path, part("?", query), part("#", r[4])))


def links(html: Column) -> Column:
    """(reference, before) of each link of a page in order: what it refers to, entities undone, and the text before it on its line."""
    pattern = r'(?i)<a\s[^>]*href="([^"]+)"[^>]*>'
    found, gaps = F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), F.split(html, pattern, -1)
    line = lambda gap: F.element_at(F.split(gap, r"(?i)<br\s*/?>|\n", -1), -1)
    each = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda r, gap: F.struct(unescaped(r).alias("reference"), line(gap).alias("before")))
    return F.when(html.rlike(pattern), each)
