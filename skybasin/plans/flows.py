"""End-to-end flows over stored tables.

``run_ts`` stamps the rows of a run.  ``as_of`` limits the join to one day; without
it, every day the run touched is joined again, so late rows reach the fact table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skybasin import fixed_values as fv
from skybasin.operators import cleaning, gold, quality, watermarks
from skybasin.operators.joining import join_sources
from skybasin.operators.upsert import last_write
from skybasin.plans.alerts import flood_alert, overall_alert
from skybasin.schemas import TABLES
from skybasin.session import side_by_side
from skybasin.sources import reference
from skybasin.sources.tables import TRIES, TableStore

HOURLY = ("air_quality", "weather")
DAILY = ("flood",)


def bronze_to_silver(
    store: TableStore,
    run_ts: str,
    sources: Iterable[str] | None = None,
    as_of: str | None = None,
    strict: bool = False,
    checks: Mapping[str, cleaning.Cleaner] = cleaning.CHECKS,
) -> tuple[DataFrame, DataFrame]:
    """Clean what is new, upsert it, join the touched days, move the marks.

    Returns those days and the metrics of the run (see ``run_flow``).
    """
    days, next_marks, metrics = _to_silver(store, run_ts, sources, as_of, strict, checks)
    refresh(store, run_ts, days, as_of, gold=False)
    store.upsert("watermarks", next_marks)
    return days, metrics


def _to_silver(
    store: TableStore,
    run_ts: str,
    sources: Iterable[str] | None,
    as_of: str | None,
    strict: bool,
    checks: Mapping[str, cleaning.Cleaner],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    sources = list(sources or fv.SOURCES)
    flow = watermarks.flow_name(sources)
    marks = store.read("watermarks")

    def clean(source: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        mark = watermarks.stored_mark(marks, flow, source)
        bronze = store.read_from_day(fv.BRONZE[source], mark and mark[:10])
        checked, days, rejects, metrics = clean_source(
            store, source, cleaning.since(bronze, mark), run_ts, strict, checks
        )
        return days, rejects, watermarks.next_mark(checked, flow, source), metrics

    done = side_by_side(store.spark, [partial(clean, source) for source in sources])
    touched, rejects, next_marks, metrics = (reduce(DataFrame.union, parts) for parts in zip(*done))
    store.append("silver_rejects", rejects)
    days = store.day(as_of) if as_of else touched.distinct().checkpoint()
    return days, next_marks, metrics.checkpoint()


def clean_source(
    store: TableStore,
    source: str,
    bronze: DataFrame,
    run_ts: str,
    strict: bool = False,
    checks: Mapping[str, cleaning.Cleaner] = cleaning.CHECKS,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clean raw rows of a source and upsert them; returns the checked rows, days, rejects and metrics."""
    # Scanned and cleaned once; rows, rejects, counts and the mark come from here.
    checked = checks[source](bronze, run_ts, strict=strict).checkpoint()
    table = fv.SILVER[source]
    cleaned = last_write(quality.valid(checked), TABLES[table].key, ["_ingested_at", "message_id"])
    days, changes = store.upsert_counted(table, cleaned)
    rejects = cleaning.quarantine(checked, source, run_ts).union(cleaning.undated(checked, source, run_ts))
    return checked, days, rejects, cleaning.cleaning_counts(checked, source).crossJoin(changes)


def refresh(store: TableStore, run_ts: str, days: DataFrame, as_of: str | None = None, gold: bool = True) -> None:
    """Join the sources of some days and, if wanted, score them; again if another flow refreshed meanwhile."""
    if days.isEmpty():
        return
    for _ in range(TRIES):
        turn = store.turn()
        inputs = [store.read(fv.SILVER[source], days) for source in fv.SOURCES]
        store.upsert(fv.SILVER["joined"], join_sources(*inputs, run_ts=run_ts, as_of=as_of))
        if gold:
            silver_to_gold(store, run_ts, days)
        if store.end_turn(turn):
            return
    raise RuntimeError(f"overtaken by other flows {TRIES} times")


def silver_to_gold(
    store: TableStore, run_ts: str, days: DataFrame | None = None
) -> None:
    """Score joined rows into the star schema: all days, or those given."""
    joined = store.read(fv.SILVER["joined"], days)
    places = reference.provinces(store.spark)
    _upsert_at_once(
        store,
        {
            fv.DIM_LOCATION: gold.build_dim_location(places, run_ts),
            fv.DIM_TIME: gold.build_dim_time(joined, run_ts),
            fv.FACT: gold.build_fact(joined, run_ts, places),
        },
    )


def run_flow(
    store: TableStore,
    run_ts: str,
    sources: Iterable[str],
    as_of: str | None = None,
    checks: Mapping[str, cleaning.Cleaner] = cleaning.CHECKS,
) -> DataFrame:
    """Raw to gold.  The marks move last: a run that broke off is simply run again.

    Returns one row per source: ``source, read, valid, dropped, inserted, modified`` (the last
    two of its silver table).  ``checks`` gives the cleaner of each source.
    """
    days, next_marks, metrics = _to_silver(store, run_ts, sources, as_of, False, checks)
    refresh(store, run_ts, days, as_of)
    store.upsert("watermarks", next_marks)
    return metrics


def hourly_flow(
    store: TableStore, run_ts: str, as_of: str | None = None, threshold: float = fv.ALERT_THRESHOLD
) -> DataFrame:
    """Air quality and weather through to the overall alert."""
    run_flow(store, run_ts, HOURLY, as_of)
    return overall_alert(store.read(fv.FACT), threshold)


def daily_flow(store: TableStore, run_ts: str, as_of: str | None = None) -> DataFrame:
    """Flood risk through to the flood alert."""
    run_flow(store, run_ts, DAILY, as_of)
    return flood_alert(store.read(fv.FACT))


def reseed(store: TableStore, export: DataFrame, run_ts: str) -> None:
    """Restore silver and gold from an export of joined rows."""
    named = last_write(
        quality.with_place_and_day(export), ["province", "date"], ["_processed_at", "hour_bucket"]
    )
    seeded = named.withColumns(
        {"_layer": F.lit("silver"), "_seeded_from": F.lit(fv.SEEDED_SILVER)}
    )
    places = reference.provinces(store.spark)
    fact = gold.build_fact(
        _with_columns(named, TABLES[fv.SILVER["joined"]].schema.fieldNames()),
        run_ts,
        places,
        fv.SEEDED_GOLD,
    )
    _upsert_at_once(
        store,
        {
            fv.DIM_LOCATION: gold.build_dim_location(places, run_ts),
            fv.DIM_TIME: gold.build_dim_time(export, run_ts),
            fv.SILVER["joined"]: seeded,
            fv.FACT: fact,
        },
    )


def _upsert_at_once(store: TableStore, updates: dict[str, DataFrame]) -> None:
    side_by_side(store.spark, [partial(store.upsert, name, rows) for name, rows in updates.items()])


def _with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = {name: F.lit(None).cast("string") for name in names if name not in df.columns}
    return df.withColumns(missing) if missing else df
