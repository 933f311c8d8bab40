"""Which sources are free and which workers are alive, from change logs.

Each log holds one row per change; the newest row of a key is its state. The
maximum is combined on the map side, so a key with very many changes ships one
row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEASE_TTL_S = 30


def latest(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key."""
    rest = [c for c in log.columns if c != key]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    newest = log.groupBy(key).agg(F.max(ranked).alias("_r"))
    return newest.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def _held(as_of: Column, ttl_s: int) -> Column:
    age = F.unix_micros(as_of) - F.unix_micros("locked_at")
    return F.coalesce(
        (F.coalesce(F.col("locked_by"), F.lit("")) != "") & (age <= ttl_s * 1_000_000), F.lit(False)
    )


def locked_sources(locks: DataFrame, as_of: Column, order: list[str], ttl_s: int = LEASE_TTL_S) -> DataFrame:
    """Sources whose newest lock row is held and not older than the lease."""
    return latest(locks, "url", order).filter(_held(as_of, ttl_s))


def one_per_url(sources: DataFrame) -> DataFrame:
    """One configured row per address."""
    return sources.groupBy("url").agg(F.min(F.struct("name", "type")).alias("_s")).select("url", "_s.name", "_s.type")


def available_sources(
    locks: DataFrame, as_of: Column, order: list[str], ttl_s: int = LEASE_TTL_S
) -> DataFrame:
    """Addresses whose newest lock row is free or has outlived the lease."""
    return latest(locks, "url", order).filter(~_held(as_of, ttl_s)).select("url")


def sources_to_scrape(
    sources: DataFrame, locks: DataFrame | None, as_of: Column, order: list[str], ttl_s: int = LEASE_TTL_S
) -> DataFrame:
    """Configured sources that are free; one without any lock row is free; without a log all are.

    The join strategy is left to the measured sizes of both sides.
    """
    configured = one_per_url(sources)
    if locks is None:
        return configured
    state = latest(locks, "url", order)
    return configured.join(state, "url", "left").filter(~_held(as_of, ttl_s)).select("url", "name", "type")


def without_locked(
    sources: DataFrame, locks: DataFrame, as_of: Column, order: list[str], ttl_s: int = LEASE_TTL_S
) -> DataFrame:
    """Sources left after the locked ones are taken out."""
    return sources.join(locked_sources(locks, as_of, order, ttl_s), "url", "left_anti")


def active_workers(heartbeats: DataFrame, as_of: Column, ttl_s: int = LEASE_TTL_S, key: str = "id") -> DataFrame:
    """Workers whose newest heartbeat is younger than two leases."""
    state = latest(heartbeats, key, ["last_heartbeat"])
    age = F.unix_micros(as_of) - F.unix_micros("last_heartbeat")
    return state.filter(age < 2 * ttl_s * 1_000_000)
