"""SYNOP (FM-12) report decoding as native column expressions.

The report is read left to right by the original decoder; the same result has
a closed form over the token array, so the whole decode is a chain of
``withColumns`` layers of built-in array / string / regex functions.  Each
layer names what the next one reads: nesting the expressions instead would
inline every token slice into every output and blow the plan up.  Header,
index and wind groups are read by position; section markers are found with
``array_position``; each section token is classified once (one regex) and the
value groups are picked by position in the class array, so the only
per-element lambda is that classification.  The readings leave through a
fence (see ``session.fence``).

Layout handled: ``[AAXX|BBXX|OOXX] YYGGiw IIiii [iRiXhVV] [Nddff [00fff]]
section-1 groups [222|333|444|555 ...]``; section 3 (after ``333``) is read
for precipitation only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import codes
from stratus.functions.scalars import (
    WHITESPACE, humidity_magnus, map_lookup, pressure_hpa, rain_mm, split_ws, strip_ws,
    tenths_signed, visibility_m,
)
from stratus.schemas import READINGS
from stratus.session import fence_columns

# A valid value group: five characters, the right lead digit, digits where the
# value is read.  Anything else in a section is skipped.  Fixed values: the
# group shapes of temperature (1), dew point (2), pressure (3, 4), rain (6)
# and low cloud (8).
_RE_VALUE_GROUP = (r"(?s)^(?:1[01][0-9]{3}|2[01][0-9]{3}|3[0-9]{4}|4[0-9]{4}"
                   r"|6[0-9]{3}.|8[0-9].{3})$")
_RE_NDDFF = r"^[0-8/]([0-9]{2}|//)([0-9]{2}|//)$"
_RE_EXT = r"^00[0-9]{3}$"

# Internal column prefix; every helper column is dropped at the end.
_P = "_syn_"


def _h(name: str) -> Column:
    return F.col(_P + name)


def _kind(token: Column) -> Column:
    """Lead digit of a valid value group (1 2 3 4 6 8), else NULL."""
    return F.when(token.rlike(_RE_VALUE_GROUP), token.substr(1, 1))


def _first_of(tokens: Column, kinds: Column, kind: str) -> Column:
    """First token of the given kind (array_position: no per-element lambda;
    ``get`` is 0-based and NULL out of range, so "not found" needs no test)."""
    return F.get(tokens, F.array_position(kinds, F.lit(kind)).cast("int") - 1)


def _last_of(tokens: Column, reversed_kinds: Column, kind: str) -> Column:
    """Last token of the given kind, found in the reversed kind array."""
    pos = F.array_position(reversed_kinds, F.lit(kind)).cast("int")
    return F.get(tokens, F.size(tokens) - pos)


def _first_marker(arr: Column, markers) -> Column:
    """0-based index of the first element that is one of ``markers``, or NULL."""
    found = [F.nullif(F.array_position(arr, F.lit(m)), F.lit(0)) for m in markers]
    return (F.least(*found) - 1).cast("int")


def _tail(arr: Column, start: Column) -> Column:
    """Elements from 1-based ``start`` to the end (empty when past the end)."""
    return F.slice(arr, start, F.greatest(F.size(arr), F.lit(1)))


def cleaned_report(report: Column) -> Column:
    """Stripped, without trailing ``=``, stripped again; NULL as empty."""
    return F.rtrim(F.rtrim(strip_ws(F.coalesce(report, F.lit(""))), F.lit("=")), F.lit(WHITESPACE))


def without_report(report: Column) -> Column:
    """Whether a report is empty or NIL."""
    text = cleaned_report(report)
    return (text == "") | F.upper(text).endswith("NIL")


def decode_reports(df: DataFrame, report_col: str = "REPORT",
                   extras: bool = False, keep_helpers: bool = False,
                   columns: list[str] | None = None) -> DataFrame:
    """Add the eight decoded readings to ``df``.

    Output columns (double): ``temp pressure humidity wind_speed wind_dir
    cloud_cover visibility_m rain_3h``.  A NIL report has all of them NULL.
    With ``extras=True`` also ``dewpoint cloud_base_m rain_duration_h`` and the
    flag ``dewpoint_gt_temp`` (unphysical dew point, still clamped to 100 %).
    ``columns`` names the readings to compute; the layers that only the others
    need are then pruned.
    Row-wise only: no shuffle, works on streaming frames too.
    """
    empty = F.array().cast("array<string>")

    # (1) cleaned text: strip, drop trailing '=', strip again
    out = df.withColumns({_P + "c": cleaned_report(F.col(report_col))})
    # (2) tokens and NIL flag
    out = out.withColumns({
        _P + "nil": F.upper(_h("c")).endswith("NIL"),
        _P + "tk": split_ws(_h("c")),
    })
    # (3) optional message type, then YYGGiw and the station number
    out = out.withColumns({
        _P + "off": F.when(F.try_element_at(_h("tk"), F.lit(1)).isin(*codes.REPORT_TYPES), 1)
        .otherwise(0),
    })
    out = out.withColumns({
        _P + "kn": F.coalesce(
            F.substring(F.try_element_at(_h("tk"), _h("off") + 1), -1, 1)
            .isin(*codes.KNOT_UNIT_CODES), F.lit(False)),
        _P + "body": _tail(_h("tk"), _h("off") + 3),
    })
    # (4) index group iRiXhVV: any five-character token in that place
    out = out.withColumns({_P + "g0": F.try_element_at(_h("body"), F.lit(1))})
    out = out.withColumns({_P + "hasir": F.coalesce(F.length(_h("g0")) == 5, F.lit(False))})
    out = out.withColumns({
        _P + "ir": F.when(_h("hasir"), _h("g0").substr(1, 1)),
        _P + "hc": F.when(_h("hasir"), _h("g0").substr(3, 1)),
        _P + "vv": F.when(_h("hasir"), _h("g0").substr(4, 2)),
        _P + "b2": F.when(_h("hasir"), _tail(_h("body"), F.lit(2))).otherwise(_h("body")),
    })
    # (5) wind / cloud group Nddff, and the 00fff extension when ff = 99
    out = out.withColumns({
        _P + "nd": F.try_element_at(_h("b2"), F.lit(1)),
        _P + "nx": F.try_element_at(_h("b2"), F.lit(2)),
    })
    out = out.withColumns({_P + "ndok": F.coalesce(_h("nd").rlike(_RE_NDDFF), F.lit(False))})
    out = out.withColumns({
        _P + "ext": _h("ndok") & (_h("nd").substr(4, 2) == "99")
        & F.coalesce(_h("nx").rlike(_RE_EXT), F.lit(False)),
    })
    out = out.withColumns({
        _P + "b3": _tail(_h("b2"), F.lit(1) + _h("ndok").cast("int") + _h("ext").cast("int")),
    })
    # (6) section 1 up to the first marker; section 3 if that marker is 333
    out = out.withColumns({_P + "m1": _first_marker(_h("b3"), codes.SECTION_MARKERS)})
    out = out.withColumns({
        _P + "s1": F.when(_h("m1").isNull(), _h("b3")).otherwise(F.slice(_h("b3"), 1, _h("m1"))),
        _P + "after": F.when(F.try_element_at(_h("b3"), _h("m1") + 1) == "333",
                             _tail(_h("b3"), _h("m1") + 2)).otherwise(empty),
    })
    out = out.withColumns({_P + "m3": _first_marker(_h("after"), codes.SECTION3_END)})
    out = out.withColumns({
        _P + "s3": F.when(_h("m3").isNull(), _h("after"))
        .otherwise(F.slice(_h("after"), 1, _h("m3"))),
    })
    # (7) each section token classified once by its group kind (its lead
    # digit when it is a valid value group, else NULL); then the groups that
    # carry values are picked by position: first valid or last valid
    out = out.withColumns({
        _P + "k1": F.transform(_h("s1"), _kind),
        _P + "k3": F.when(_h("ir").isin("0", "2"), F.transform(_h("s3"), _kind)),
    })
    out = out.withColumns({_P + "r1": F.reverse(_h("k1"))})
    out = out.withColumns({
        _P + "g1": _last_of(_h("s1"), _h("r1"), "1"),
        _P + "g2": _last_of(_h("s1"), _h("r1"), "2"),
        _P + "g3": _first_of(_h("s1"), _h("k1"), "3"),
        _P + "g4": _last_of(_h("s1"), _h("r1"), "4"),
        _P + "g6": _last_of(_h("s1"), _h("r1"), "6"),
        _P + "g6s3": _first_of(_h("s3"), _h("k3"), "6"),
        _P + "g8": _first_of(_h("s1"), _h("k1"), "8"),
    })
    # (8) numbers
    n, dd, ff = (_h("nd").substr(1, 1), _h("nd").substr(2, 2), _h("nd").substr(4, 2))
    out = out.withColumns({
        _P + "t": tenths_signed(_h("g1")),
        _P + "td": tenths_signed(_h("g2")),
        _P + "rg": F.coalesce(_h("g6"), _h("g6s3")),
        _P + "wsr": F.when(_h("ext"), _h("nx").substr(3, 3).cast("int").cast("double"))
        .when(_h("ndok") & ff.rlike("^[0-9]{2}$") & (ff != "99"), ff.cast("int").cast("double")),
    })
    values = {
        "temp": _h("t"),
        "pressure": F.coalesce(pressure_hpa(_h("g4")), pressure_hpa(_h("g3"))),
        "humidity": humidity_magnus(_h("t"), _h("td")),
        "wind_speed": F.when(_h("kn"), F.round(_h("wsr") * codes.KNOT_TO_MS, 1))
        .otherwise(_h("wsr")),
        "wind_dir": F.when(_h("ndok") & dd.rlike("^[0-9]{2}$") & (dd != "99"),
                           dd.cast("int") * 10.0),
        "cloud_cover": F.coalesce(
            F.when(_h("ndok") & n.rlike("^[0-8]$"), n.cast("int")),
            _h("g8").substr(2, 1).cast("int")).cast("double"),
        "visibility_m": visibility_m(_h("vv")),
        "rain_3h": F.coalesce(rain_mm(_h("rg")), F.when(_h("ir") == "3", F.lit(0.0))),
    }
    if extras:
        values.update({
            "dewpoint": _h("td"),
            "cloud_base_m": map_lookup({k: float(v) for k, v in codes.CLOUD_BASE_M.items()},
                                       _h("hc")),
            "rain_duration_h": map_lookup(
                {k: float(v) for k, v in codes.RAIN_DURATION_H.items()},
                _h("rg").substr(5, 1)),
        })
    if columns is not None:
        values = {k: v for k, v in values.items() if k in columns}
    final = {k: F.when(_h("nil"), F.lit(None).cast("double")).otherwise(v.cast("double"))
             for k, v in values.items()}
    if extras and (columns is None or "dewpoint_gt_temp" in columns):
        final["dewpoint_gt_temp"] = F.coalesce(~_h("nil") & (_h("td") > _h("t")), F.lit(False))
    if keep_helpers:
        return out.withColumns(final)
    # The readings leave through a fence (a one-row generator): a later filter
    # on a reading is not pushed into the layers above, which would copy every
    # token slice into the condition and explode the plan.
    passthrough = [F.col(f"`{c}`") for c in out.columns if not c.startswith(_P)]
    return out.select(*passthrough, fence_columns(final))


def reading_columns(extras: bool = False) -> list[str]:
    cols = list(READINGS)
    if extras:
        cols += ["dewpoint", "cloud_base_m", "rain_duration_h", "dewpoint_gt_temp"]
    return cols
