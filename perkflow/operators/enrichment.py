"""Home-to-office distance enrichment.

The original job called a distance service once per employee from the driver,
even for repeated addresses. Here the work is set based:

    distinct addresses -> minus addresses already resolved (cache)
    -> provider lookup on the executors -> decode -> plus cache
    -> joined back to the employees

A provider turns a DataFrame of addresses into ``home_address, reply``.
``StoredReplies`` answers from a table of replies (tests, replays);
``CallbackProvider`` calls a Python function once per Arrow batch of distinct
addresses inside ``mapInPandas``, which is where an HTTP client plugs in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DISTANCE_ERROR
from ..functions.distance import decode_replies

RESOLVED_COLUMNS = ["home_address", "home_to_office_km", "distance_check_status"]


class DistanceProvider(Protocol):
    """Turns distinct addresses into replies; runs on the executors."""

    def lookup(self, addresses: DataFrame) -> DataFrame:
        """``home_address`` -> ``home_address, reply`` (JSON text or NULL), one row per address."""
        ...


class StoredReplies:
    """Replies kept in a table ``home_address, reply`` (one row per address).
    An address without a row gets an empty reply (status ``error``): the
    service is there, it only has no answer."""

    def __init__(self, replies: DataFrame):
        self.replies = replies.select("home_address", "reply")

    def lookup(self, addresses: DataFrame) -> DataFrame:
        known = self.replies.withColumn("_listed", F.lit(True))
        found = addresses.join(known, "home_address", "left")
        return found.select("home_address", F.when(F.col("_listed"), F.col("reply")).otherwise(F.lit("")).alias("reply"))


class CallbackProvider:
    """Calls ``fetch(addresses) -> replies`` (JSON text or None per address) on the executors.

    A failing batch call is retried address by address; an address whose call
    still fails, or is answered with None, gets an empty reply, which decodes
    to status ``error`` — one bad call never fails the run. ``max_callers`` caps how many tasks call
    the service at the same time (rate-limited APIs).
    """

    def __init__(self, fetch: Callable[[Sequence[str]], Sequence[str | None]], max_callers: int | None = None):
        self.fetch = fetch
        self.max_callers = max_callers

    def lookup(self, addresses: DataFrame) -> DataFrame:
        fetch = self.fetch
        if self.max_callers:
            addresses = addresses.repartition(self.max_callers)

        def one(address: str) -> str | None:
            try:
                return fetch([address])[0]
            except Exception:  # noqa: BLE001 - the status column records the failure
                return ""

        def call(batches: Iterator) -> Iterator:
            import pandas as pd

            for pdf in batches:
                addr = pdf["home_address"].tolist()
                try:
                    replies = list(fetch(addr)) if addr else []
                except Exception:  # noqa: BLE001
                    replies = [one(a) for a in addr]
                yield pd.DataFrame({"home_address": addr, "reply": [r or "" for r in replies]})

        return addresses.mapInPandas(call, "home_address string, reply string")


class NoKeyProvider:
    """No service configured: every address gets no reply (status no_api_key)."""

    def lookup(self, addresses: DataFrame) -> DataFrame:
        return addresses.withColumn("reply", F.lit(None).cast("string"))


def resolve_addresses(addresses: DataFrame, provider: DistanceProvider, cache: DataFrame | None = None) -> DataFrame:
    """``home_address, home_to_office_km, distance_check_status`` for each distinct non-null address."""
    todo = addresses.select("home_address").where("home_address IS NOT NULL").distinct()
    if cache is not None:
        todo = todo.join(cache.select("home_address"), "home_address", "left_anti")
    fresh = decode_replies(provider.lookup(todo).select("home_address", "reply")).select(*RESOLVED_COLUMNS)
    if cache is None:
        return fresh
    return fresh.unionByName(cache.select(*RESOLVED_COLUMNS))


def enrich_distances(employees: DataFrame, provider: DistanceProvider, cache: DataFrame | None = None) -> DataFrame:
    """Employees plus ``home_to_office_km`` and ``distance_check_status``."""
    return with_distances(employees, resolve_addresses(employees, provider, cache))


def with_distances(employees: DataFrame, resolved: DataFrame) -> DataFrame:
    """Employees joined to resolved addresses; without an address the status is ``error``."""
    joined = employees.join(resolved.select(*RESOLVED_COLUMNS), "home_address", "left")
    return joined.withColumn("distance_check_status", F.coalesce("distance_check_status", F.lit(DISTANCE_ERROR)))
