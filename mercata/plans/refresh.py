"""Full refresh of a warehouse folder from a nested event export.

Steps in order: flatten, clean, marts, load gate, touchpoints and attribution, checks. Staging and
mart tables are written, and what follows reads the written tables: each step is computed once,
a lost executor costs only the running step, and joins know the size of the tables they read. The
cleaning log is counted while the staging tables are written, the summary of the checks is taken
from their written log.

All tables of a refresh become visible with one commit at its end (``sources/snapshots.py``). Until
then, and if a step fails, readers see the last refresh.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from mercata import schemas
from mercata.operators import clean, quality
from mercata.plans import gate, views
from mercata.session import scratch_folder
from mercata.sources import readers, snapshots, writers

STORED_RESULTS = ("channel_attribution", "customer_touchpoints")


class Refreshed(NamedTuple):
    marts: dict[str, DataFrame]
    views: dict[str, DataFrame]
    cleaning_log: DataFrame
    quality_summary: DataFrame
    quarantine: DataFrame
    version: int


def refresh(spark: SparkSession, export: str, target: str, *, date_from: str, date_to: str,
            channels: DataFrame, campaigns: DataFrame, ad_spend: DataFrame,
            file_order: Sequence[str] = ("event_timestamp",), run: str | None = None) -> Refreshed:
    """``export`` is partitioned by event_date (``yyyyMMdd``), the bounds are given
    alike. ``channels``, ``campaigns`` and ``ad_spend`` are raw frames. Views are
    registered in the session under their names. ``quarantine`` counts the rows that the
    load gate refused; the rows are in the quarantine tables with their reason. The tables are
    those of ``version``. A refresh that is repeated under its ``run`` id replaces its log entries."""
    commit = snapshots.Store(spark, target).begin(run)
    scratch = scratch_folder(spark, "gate")

    def stored(kind: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {name: commit.replace(f"{kind}/{name}", df) for name, df in frames.items()}

    def keep(name: str, df: DataFrame) -> DataFrame:
        return writers.stored(df, f"{scratch}/{name}")

    def total(df: DataFrame) -> list[str]:
        """The given order, then all other columns: the row kept of equal keys does not depend
        on partitioning, and a task run again keeps the same one."""
        return [*file_order, *[c for c in df.columns if c not in file_order]]

    flat = readers.flatten_events(readers.scan_events(spark, export, date_from, date_to))
    sold = readers.explode_items(
        readers.scan_events(spark, export, date_from, date_to, readers.ITEM_EVENT_NAMES))
    cleaned = {"events": (clean.clean_events(flat, total(flat)), schemas.STAGED_EVENTS),
               "items": (clean.clean_items(sold, total(sold)), schemas.STAGED_ITEMS),
               "channels": (clean.clean_channels(channels, ["channel_name", "channel_type"]), schemas.CHANNELS),
               "campaigns": (clean.clean_campaigns(campaigns), schemas.CAMPAIGNS),
               "ad_spend": (clean.clean_ad_spend(ad_spend, ["spend_id"]), schemas.AD_SPEND)}
    staging, watched = {}, {}
    for name, (file, shape) in cleaned.items():
        rows, watched[file.file] = file.observed()
        staging |= stored("staging", {name: writers.conform_schema(rows, shape)})
    cleaning = commit.replace("cleaning_log", clean.observed_log(spark, watched))
    gated = gate.gate(views.build_marts(**staging), keep)
    marts = stored("marts", gated.loaded)
    out = views.build_views(marts)
    results = gate.gate({name: out[name] for name in STORED_RESULTS}, keep, gate.RESULT_CONTRACTS, marts)
    out.update(stored("results", results.loaded))
    out["vw_attribution_comparison"] = views.comparison(marts, out["channel_attribution"])

    def day(text: str) -> str:
        return f"{text[:4]}-{text[4:6]}-{text[6:]}"

    report = views.quality_checks(marts, day(date_from), day(date_to))
    log = gate.gate({"data_quality_log": report.log}, keep, gate.RESULT_CONTRACTS)
    checked = commit.append("data_quality_log", log.loaded["data_quality_log"])
    refused = stored("quarantine", {**gated.refused, **results.refused, **log.refused})
    version = commit.commit()
    views.register_views(out)
    return Refreshed(marts, out, cleaning, quality.summary(checked), gate.summary(refused), version)
