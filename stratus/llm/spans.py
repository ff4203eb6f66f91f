"""Places of pattern matches inside texts, by array functions alone.

Positions are code points, end exclusive.  Running figures over an array are
taken in chunks, so what a fold copies stays short however long the array is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Array elements that one fold walks over.
CHUNK = 256
SPAN = "array<struct<start:int,end:int,kind:string,rank:int,found:string>>"
LISTED = "array<struct<start:int,rank:int,end:int,kind:string>>"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, merge) -> Column:
    """Running ``merge`` (associative) of an array's elements."""
    def walk(xs: Column) -> Column:
        return F.aggregate(F.slice(xs, 2, F.size(xs)), F.slice(xs, 1, 1),
                           lambda a, x: F.concat(a, F.array(merge(F.element_at(a, -1), x))))

    def whole(values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(values), F.lit(CHUNK))
        chunks = F.transform(starts, lambda s: walk(F.slice(values, s, F.lit(CHUNK))))
        return let(chunks, lambda inner: let(
            walk(F.transform(inner, lambda c: F.element_at(c, -1))),
            lambda before: F.flatten(F.transform(inner, lambda c, k: F.when(k == 0, c).otherwise(
                F.transform(c, lambda x: merge(F.element_at(before, k), x)))))))

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(v))


def spans_of(text: Column, pattern: str, kind: str, rank: int, guard: Column | None = None) -> Column:
    """All matches of ``pattern`` with their places: the pieces between matches
    and the matches' lengths add up to them."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def placed(hits: Column) -> Column:
        steps = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: g + F.length(h))
        return F.zip_with(hits, running(steps, lambda a, b: a + b), lambda h, e: F.struct(
            (e - F.length(h)).alias("start"), e.alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"),
            h.alias("found")))

    there = F.regexp_like(text, F.lit(pattern))
    return F.when(there if guard is None else guard & there,
                  let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(F.array().cast(SPAN))


def outside(candidates: Column, known: Column) -> Column:
    """The ``candidates`` (disjoint, in order) that overlap none of ``known``:
    by one sweep over known starts and candidate ends, in which the furthest
    known end so far decides."""
    def sweep(both: Column) -> Column:
        found, spans = both["c"], both["k"]
        events = F.array_sort(F.concat(
            F.transform(found, lambda c: F.struct(c["end"].alias("at"), F.lit(0).alias("known"), F.lit(0).alias("reach"),
                                                  c["start"].alias("start"))),
            F.transform(spans, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("known"), s["end"].alias("reach"),
                                                  s["start"].alias("start")))))
        reach = let(events, lambda ev: F.zip_with(ev, running(F.transform(ev, lambda e: e["reach"]), F.greatest), lambda e, r: F.struct(
            e["known"].alias("known"), (r <= e["start"]).alias("free"))))
        free = F.transform(F.filter(reach, lambda e: e["known"] == 0), lambda e: e["free"])
        marked = F.zip_with(found, free, lambda c, f: F.struct(c.alias("span"), f.alias("free")))
        return F.transform(F.filter(marked, lambda m: m["free"]), lambda m: m["span"])

    return let(F.struct(candidates.alias("c"), known.alias("k")), lambda both: F.when(
        (F.size(both["c"]) > 0) & (F.size(both["k"]) > 0), sweep(both)).otherwise(both["c"]))


def in_order(spans: Column) -> Column:
    """By start, then kind as listed."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, spans: Column, label) -> Column:
    """``text`` with every one of ``spans`` (in order, overlapping or not) put as
    ``label(span, cut)``, where ``cut(lo, hi)`` gives code points of the text."""
    size = 1000

    def rebuilt(chunks: Column) -> Column:
        def cut(lo: Column, hi: Column) -> Column:
            a, b = F.floor(lo / size).cast("int"), F.floor(hi / size).cast("int")

            def part(k: Column, start: Column, n: Column) -> Column:
                return F.coalesce(F.substring(F.get(chunks, k), start + 1, n), F.lit(""))

            return F.when(hi <= lo, "").when(a == b, part(a, lo % size, hi - lo)).otherwise(F.concat(
                part(a, lo % size, F.lit(size)), F.array_join(F.slice(chunks, a + 2, b - a - 1), ""),
                part(b, F.lit(0), hi % size)))

        def joined(ends: Column) -> Column:
            pieces = F.transform(spans, lambda s, k: let(F.when(k == 0, 0).otherwise(F.element_at(ends, F.greatest(k, F.lit(1)))), lambda done: F.concat(
                cut(done, s["start"]), F.when(s["end"] > done, label(s, cut)).otherwise(""))))
            return F.concat(F.array_join(pieces, ""), cut(F.element_at(ends, -1), F.length(text)))

        return let(running(F.transform(spans, lambda s: s["end"]), F.greatest), joined)

    return F.when(F.size(spans) > 0, let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0)), rebuilt)).otherwise(text)
