"""Notification wording, built from columns (no Python per row).

Three sentence shapes:
  * known verb + distance:  "Bravo N ! Tu viens de courir 5,2 km en 30 min !"
  * other sport + distance: "Bravo N ! Tu viens de faire 30 min de tennis sur 2,3 km !"
  * no distance:            "Bravo N ! 45 min d'escalade bouclées !"
then a space and the sport emoji, then ' ("comment")' when a comment is set.
The message is NULL when the reference formatter would fail (no sport, no
duration, empty sport without distance); such rows go to the dead letters.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DEFAULT_EMOJI, DEFAULT_VERB, ELISION_LETTERS, SPORT_EMOJI, SPORT_VERB


def _lookup(mapping: dict[str, str], key: Column, default: str) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(m, key), F.lit(default))


def sport_emoji(sport: Column) -> Column:
    return _lookup(SPORT_EMOJI, sport, DEFAULT_EMOJI)


def sport_verb(sport: Column) -> Column:
    return _lookup(SPORT_VERB, sport, DEFAULT_VERB)


def whole_minutes(duration_s: Column) -> Column:
    return F.floor(duration_s / F.lit(60))


def km_one_decimal_fr(distance_m: Column) -> Column:
    """``distance_m / 1000`` with one decimal, half-even on the double, comma separator."""
    km = distance_m / F.lit(1000.0)
    return F.replace(F.call_function("format_number", km, F.lit("0.0")), F.lit("."), F.lit(","))


def has_distance(distance_m: Column) -> Column:
    return distance_m.isNotNull() & (distance_m > 0)


def message_text(full_name: Column, sport: Column, distance_m: Column, duration_s: Column,
                 comment: Column) -> Column:
    sport_lower = F.lower(sport)
    minutes = whole_minutes(duration_s).cast("string")
    dist = km_one_decimal_fr(distance_m)
    verb = sport_verb(sport)
    bravo = F.concat(F.lit("Bravo "), full_name, F.lit(" ! "))
    with_generic_verb = F.concat(
        bravo, F.lit("Tu viens de faire "), minutes, F.lit(" min de "), sport_lower,
        F.lit(" sur "), dist, F.lit(" km !"),
    )
    with_verb = F.concat(
        bravo, F.lit("Tu viens de "), verb, F.lit(" "), dist, F.lit(" km en "), minutes, F.lit(" min !")
    )
    connector = F.when(F.substring(sport_lower, 1, 1).isin(list(ELISION_LETTERS)), F.lit("d'")).otherwise(
        F.lit("de ")
    )
    without_distance = F.concat(bravo, minutes, F.lit(" min "), connector, sport_lower, F.lit(" bouclées !"))
    base = (
        F.when(has_distance(distance_m) & (verb == DEFAULT_VERB), with_generic_verb)
        .when(has_distance(distance_m), with_verb)
        .when(F.length(sport) > 0, without_distance)
    )
    tail = F.when(comment.isNotNull() & (comment != ""), F.concat(F.lit(' ("'), comment, F.lit('")'))).otherwise(
        F.lit("")
    )
    ok = sport.isNotNull() & duration_s.isNotNull()
    return F.when(ok, F.concat(base, F.lit(" "), sport_emoji(sport), tail))


def failure_reason(sport: Column, distance_m: Column, duration_s: Column) -> Column:
    """Why ``message_text`` is NULL (NULL when it is not)."""
    return (
        F.when(sport.isNull(), F.lit("missing sport_type"))
        .when(duration_s.isNull(), F.lit("missing duration_s"))
        .when(~has_distance(distance_m) & (F.length(sport) == 0), F.lit("empty sport_type"))
    )


def outbox_body(text: Column) -> Column:
    """Request body of one chat notification: ``{"text": <message>}``."""
    return F.to_json(F.struct(text.alias("text")))
