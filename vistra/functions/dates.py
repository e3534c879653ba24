"""Timestamp expressions on TIMESTAMP_NTZ.

Everything here is independent of ``spark.sql.session.timeZone``: values are
wall-clock times without a zone, so we avoid functions that pass through
TIMESTAMP (``date_trunc``, ``date_format``), which shift times that fall in a
daylight-saving gap of the session zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vistra.schema import TIMESTAMP_FORMS, TIMESTAMP_PATTERN

EPOCH_NTZ_TEXT = "1970-01-01 00:00:00"
MICROS_PER_DAY = 86400.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _trimmed(c: dict[str, Column]) -> dict[str, Column]:
    return {"t": F.btrim(c["t"], F.lit(" \t\r\n"))}


def _told_apart(c: dict[str, Column]) -> dict[str, Column]:
    usual = F.coalesce(c["t"].rlike(TIMESTAMP_PATTERN), F.lit(True))
    return {"usual": usual, "rest": F.when(~usual, F.replace(c["t"], F.lit("T"), F.lit(" ")))}


def _date(c: dict[str, Column]) -> dict[str, Column]:
    """The part before the first blank or T, of the other forms."""
    return {"date": F.substring_index(c["rest"], " ", 1)}


def _dashed(c: dict[str, Column]) -> dict[str, Column]:
    """``MM/DD/YYYY`` (by its slashes) and ``YYYYMMDD`` (eight characters, the fifth no dash) as ``YYYY-MM-DD``; what follows the date."""
    d, rest = c["date"], c["rest"]
    month, year = F.substring_index(d, "/", 1), F.substring_index(d, "/", -1)
    day = F.substring(d, F.length(month) + 2, F.length(d) - F.length(month) - F.length(year) - 2)
    compact = (F.length(d) == 8) & (F.substring(d, 5, 1) != "-")
    dashed = F.when(F.contains(d, F.lit("/")), F.concat_ws("-", year, month, day)).when(
        compact, F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))
    )
    return {"time": F.when(F.length(d) < F.length(rest), F.substring(rest, F.length(d) + 2, F.length(rest))), "date": dashed.otherwise(d)}


def _zone(c: dict[str, Column]) -> dict[str, Column]:
    """``Z``, ``+HH:MM`` or ``+HHMM`` at the end of a time: how many characters it has."""
    w = c["time"]
    return {
        "zone": F.when(F.endswith(w, F.lit("Z")), F.lit(1))
        .when(F.substring(w, -6, 1).isin("+", "-"), F.lit(6))
        .when(F.substring(w, -5, 1).isin("+", "-"), F.lit(5))
        .otherwise(F.lit(0))
    }


def _wall(c: dict[str, Column]) -> dict[str, Column]:
    """The time without its zone, and the zone with its colon."""
    w, n = c["time"], c["zone"]
    mark = F.when(n == 5, F.concat(F.substring(w, -5, 3), F.lit(":"), F.substring(w, -2, 2))).when(n == 6, F.substring(w, -6, 6)).when(n == 1, F.lit("Z"))
    return {"wall": F.substring(w, F.lit(1), F.length(w) - n), "mark": mark}


def _whole(c: dict[str, Column]) -> dict[str, Column]:
    """All forms in one: ``YYYY-M-D``, a blank, ``H:MM:SS.f``, the zone; ``H:MM`` gets its seconds."""
    wall = c["wall"]
    seconds = F.when((F.length(wall) <= 5) & F.contains(wall, F.lit(":")), F.concat(wall, F.lit(":00"))).otherwise(wall)
    return {"whole": F.concat(c["date"], F.coalesce(F.concat(F.lit(" "), seconds, F.coalesce(c["mark"], F.lit(""))), F.lit("")))}


def _value(c: dict[str, Column]) -> dict[str, Column]:
    whole = c["whole"]
    # text with a zone names an instant; its UTC wall time follows from the epoch, whatever the session's zone
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(whole.try_cast("timestamp")), F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz"))
    other = F.when(whole.rlike(TIMESTAMP_FORMS), F.when(c["mark"].isNotNull(), utc).otherwise(whole.try_cast("timestamp_ntz")))
    return {"value": F.when(c["usual"], c["t"].try_cast("timestamp_ntz")).otherwise(other)}


# A projection each: a result that the next one uses more than once is computed once a row.
# The usual form takes one pattern and one cast; all else is NULL for it from the second step on.
_STEPS = [_trimmed, _told_apart, _date, _dashed, _zone, _wall, _whole, _value]


def parse_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with its text ``columns`` parsed as ``parse_timestamp`` does, all of them in the same few projections."""
    names = df.columns
    held = {c: {"t": F.col(f"`{c}`").cast("string")} for c in columns}
    for step in _STEPS:
        new = {}
        for c in columns:
            made = step(held[c])
            new |= {f"__{c}_{k}": v for k, v in made.items()}
            held[c] |= {k: F.col(f"`__{c}_{k}`") for k in made}
        df = df.withColumns(new)
    return df.select(*[held[n]["value"].alias(n) if n in held else F.col(f"`{n}`") for n in names])


def parse_timestamp(text: Column | str) -> Column:
    """Text → TIMESTAMP_NTZ; text that is not a valid date-time → NULL.

    Mirrors a coercing parser (bad values become missing) with a fixed list of
    forms: ``YYYY-MM-DD`` (one-digit parts too), ``YYYYMMDD`` or ``MM/DD/YYYY``
    (month first), alone or followed by a blank or ``T`` and ``H:MM``,
    ``H:MM:SS`` or ``H:MM:SS.f`` with up to nine digits, cut to microseconds. A
    time may end in ``Z`` or an offset; its value is then the UTC wall time.
    ``'2010'`` and ``'not-a-date'`` are NULL.

    One expression, for single values; ``parse_texts`` is for whole columns.
    """
    held, names = F.struct(_col(text).cast("string").alias("t")), ["t"]
    for step in _STEPS:
        held = F.transform(F.array(held), _bound(step, names))[0]
        names = list(dict.fromkeys([*names, *step({k: F.lit("") for k in _PARTS})]))
    return held["value"]


_PARTS = ("t", "usual", "rest", "date", "time", "zone", "wall", "mark", "whole")


def _bound(step, names: list[str]):
    """A step from a struct of what is known to one with its results."""

    def bind(s: Column) -> Column:
        made = step({k: s[k] for k in names})
        return F.struct(*[s[k].alias(k) for k in names if k not in made], *[v.alias(k) for k, v in made.items()])

    return bind


def duration_days(start: Column | str, end: Column | str) -> Column:
    """Fractional days from start to end: whole microseconds / 1e6 / 86400."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / 1e6 / MICROS_PER_DAY


def clip_at_zero(value: Column | str) -> Column:
    """Negative → 0.0; NULL stays NULL (``greatest`` would turn NULL into 0)."""
    v = _col(value)
    return F.when(v < 0, F.lit(0.0)).otherwise(v)


def truncate_to_millis(ts: Column | str) -> Column:
    """Drop sub-millisecond digits (floor), keeping TIMESTAMP_NTZ."""
    t = _col(ts)
    epoch = F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, t)
    return F.timestamp_add("MICROSECOND", -F.pmod(micros, F.lit(1000)), t)


def timestamp_to_text(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ → ``yyyy-MM-dd HH:mm:ss`` (fraction dropped), zone-free."""
    return F.substring(_col(ts).cast("string"), 1, 19)


def microsecond_of(ts: Column | str) -> Column:
    """The microseconds (0..999999) of a TIMESTAMP_NTZ's second."""
    epoch = F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz")
    return F.pmod(F.timestamp_diff("MICROSECOND", epoch, _col(ts)), F.lit(1_000_000))


def period_label(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM`` label: year as text, month zero-padded to two digits."""
    return F.concat(
        _col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0")
    )
