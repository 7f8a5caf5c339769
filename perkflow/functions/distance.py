"""Decoding of distance-service replies (JSON text) into (km, status) columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DISTANCE_ERROR, DISTANCE_NO_KEY, DISTANCE_NOT_FOUND, DISTANCE_OK
from ..schemas import DISTANCE_REPLY
from .numeric import metres_to_km_2dp


def parse_reply(reply: Column) -> Column:
    """JSON text -> reply struct; text that is not JSON gives NULL fields."""
    return F.from_json(reply, DISTANCE_REPLY)


def _first_element(parsed: Column) -> Column:
    first_row = F.try_element_at(parsed.getField("rows"), F.lit(1))
    return F.try_element_at(first_row.getField("elements"), F.lit(1))


def distance_status(reply: Column, parsed: Column) -> Column:
    """Status of one reply.

    no reply -> no_api_key; unparsable or global status != OK -> error;
    no first element -> error; element status != OK -> not_found;
    element without a distance -> error; otherwise ok.
    """
    elem = _first_element(parsed)
    return (
        F.when(reply.isNull(), F.lit(DISTANCE_NO_KEY))
        .when(F.coalesce(parsed.getField("status"), F.lit("")) != "OK", F.lit(DISTANCE_ERROR))
        .when(elem.isNull(), F.lit(DISTANCE_ERROR))
        .when(F.coalesce(elem.getField("status"), F.lit("")) != "OK", F.lit(DISTANCE_NOT_FOUND))
        .when(elem.getField("distance").getField("value").isNull(), F.lit(DISTANCE_ERROR))
        .otherwise(F.lit(DISTANCE_OK))
    )


def distance_km(status: Column, parsed: Column) -> Column:
    """Kilometres (2 decimals) when the status is ok, else NULL."""
    metres = _first_element(parsed).getField("distance").getField("value")
    return F.when(status == DISTANCE_OK, metres_to_km_2dp(metres))


def decode_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """``replies`` plus ``home_to_office_km`` and ``distance_check_status``.

    The parsed reply leaves a one-element generator before the status and the
    kilometres are taken from it, so the text is parsed once per row (a plain
    projection would be merged and parse once per use).
    """
    parsed = replies.select("*", F.inline(F.array(F.struct(parse_reply(F.col(reply)).alias("_parsed")))))
    status = distance_status(F.col(reply), F.col("_parsed"))
    marked = parsed.withColumn("distance_check_status", status)
    return marked.withColumn("home_to_office_km", distance_km(F.col("distance_check_status"), F.col("_parsed"))).drop("_parsed")
