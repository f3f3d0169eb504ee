"""Text rules on raw events and on finished columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventweft.functions import paths


def repair_raw(raw: str) -> Column:
    """Mend JSON text whose quotes were doubled by an extra CSV round; leave text that parses."""
    unwrapped, mended = paths.raw_forms_sql(raw)
    sound = lambda text: f"{paths.strict_variant_sql(text)} IS NOT NULL"
    return F.expr(
        f"CASE WHEN NOT {paths.quoted_whole_sql(raw)} AND {sound(f'`{raw}`')} THEN `{raw}` "
        f"WHEN {sound(unwrapped)} THEN {unwrapped} WHEN {sound(mended)} THEN {mended} ELSE `{raw}` END"
    )


def header_time(text: Column) -> Column:
    """Event time from a header, read by its fixed places: ten of the date, one between, eight of the time.

    What follows is the fraction, of up to six digits, then a zone. The zone is dropped, not applied.
    ``08:07:19192`` and ``08:07:192`` lost the point of their fraction; its digits count all the same.
    """
    told = F.trim(text)
    date, between, clock = F.substring(told, 1, 10), F.substring(told, 11, 1), F.substring(told, 12, 8)
    rest = F.substring(told, 20, 1 << 20)
    digits = F.regexp_extract(rest, r"^\.?(\d{0,6})", 1)
    zone = F.trim(F.regexp_replace(rest, r"^(\.\d)?\d*", ""))
    zone_known = (zone == "") | (zone == "Z") | zone.rlike(r"^[+-]\d\d:?\d\d$")
    shaped = date.rlike(r"^\d{4}-\d\d-\d\d$") & between.isin("T", " ") & clock.rlike(r"^\d\d:\d\d:\d\d$")
    exact = rest.rlike(r"^(\.\d{1,6}|\d{0,6})(\D|$)")
    return F.when(shaped & exact & zone_known, F.concat(date, F.lit(" "), clock, F.lit("."), F.rpad(digits, 6, "0")).try_cast("timestamp"))


# Where the envelope of every event holds its time and type.
TIME_PATH = "messageHeader.timestamp"
NAME_PATH = "eventInfo.name"


def header_fields(doc: str) -> list[Column]:
    return [
        header_time(paths.scalar(doc, TIME_PATH)).alias("event_timestamp"),
        paths.scalar(doc, NAME_PATH).alias("event_name"),
    ]


def abbreviate_name(name: Column) -> Column:
    """``Grand River Plus Inn`` to ``GR Plus Inn``: of three words or more, the first two become initials
    if they are of plain letters; single blanks part words."""
    words = F.split(name, " ", 3)
    plain = F.forall(F.slice(words, 1, 2), lambda w: w.rlike("^[A-Za-z]+$"))
    initials = F.array_join(F.transform(F.slice(words, 1, 2), lambda w: F.upper(F.left(w, F.lit(1)))), "")
    rest = F.element_at(words, -1)
    return F.when((F.size(words) == 3) & plain & (rest != ""), F.concat_ws(" ", initials, rest)).otherwise(name)


def normalise_code(code: Column, labels: Mapping[str, str]) -> Column:
    """Known codes, in any case, become labels; others stay as they are."""
    pairs = [F.lit(t) for pair in labels.items() for t in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(code)), code)
