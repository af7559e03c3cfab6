"""The cleaning run: order log in, stored fact table out."""

from __future__ import annotations

import threading
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from courierlens.operators import quality
from courierlens.operators.cleaning import clean_orders
from courierlens.settings import DEFAULT, SlaConfig
from courierlens.sources import event_orders, fact_table, order_log, shared
from courierlens.sources.layout import Layout

COPIES = "copies"
_build_lock = threading.Lock()


def run_cleaning(
    spark: SparkSession,
    raw_path: str,
    fact_path: str,
    config: SlaConfig = DEFAULT,
    *,
    refresh: bool = True,
    partitions: int | None = None,
    splittable: bool = False,
    layout: Layout | None = None,
) -> DataFrame:
    """Clean a CSV order log into a stored fact table and read it back.

    Builds anew unless ``refresh`` is off and a table of this configuration is
    there. ``partitions`` sizes the one shuffle (``build_session``), ``splittable``
    is for logs without line breaks inside fields (``scan_raw``). The figures of
    ``cleaning_report`` are observed as the rows are written. With a ``layout`` the table
    is stored once more, clustered.
    """
    built = fact_table.build_if_missing(
        spark,
        fact_path,
        lambda session: clean_orders(
            order_log.scan_raw(session, raw_path, splittable=splittable), config, COPIES
        ),
        config,
        refresh=refresh,
        partitions=partitions,
        observed=quality.observed_figures(config, COPIES),
    )
    return built if layout is None else fact_table.recluster(spark, fact_path, layout, config)


def cleaning_report(
    spark: SparkSession, fact_path: str, config: SlaConfig = DEFAULT
) -> DataFrame | None:
    """The quality report of the newest ``run_cleaning``, without reading orders.

    The row that ``quality.quality_report`` gives of the raw log and the table, and the
    number of raw rows that were dropped as copies. None if that run observed nothing.
    """
    figures = fact_table.build_figures(spark, fact_path, config)
    return figures and quality.report_of_figures(spark, figures, config)


def event_table_path(
    spark: SparkSession, data_dir: str, name: str, *, refresh: bool = False
) -> str:
    """Path of a table derived from the events.

    The version of the source is part of the path; it is looked up once per
    application, again with ``refresh``.
    """
    source = f"{data_dir}/events.parquet"
    version = shared.stored_version(spark, source, refresh=refresh)
    key = sha256(repr((source, version)).encode()).hexdigest()[:16]
    return shared.table_path(spark, key, name)


def event_deliveries(
    spark: SparkSession,
    data_dir: str,
    *,
    refresh: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """The fact table of the orders an events table stands for.

    Cleaned and stored once per application: the wide step, dropping duplicate
    rows, runs in that one job and every query then reads only the columns it
    needs. ``refresh`` looks whether the events have changed since.
    """
    path = event_table_path(spark, data_dir, "deliveries", refresh=refresh)
    with _build_lock:
        return fact_table.build_if_missing(
            spark,
            path,
            lambda session: clean_orders(event_orders.load_orders(session, data_dir)),
            partitions=partitions,
        )
