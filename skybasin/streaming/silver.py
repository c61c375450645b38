"""The cleaned layer and the star schema as a stream over the raw tables.

The checkpoint keeps which files have been read, in the place of stamps: a file that appears while
an append is under way belongs to the next batch, whatever stamps its rows bear.  A batch
that runs again upserts the same rows and may list its rejects again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skybasin import fixed_values as fv
from skybasin.operators import cleaning
from skybasin.plans.flows import clean_source, refresh
from skybasin.schemas import TABLES
from skybasin.session import side_by_side
from skybasin.sources.tables import DAY, TableStore
from skybasin.streaming.bronze import utc_now

_OF = "__raw"


def read_raw(store: TableStore, source: str, max_files: int | None = None) -> DataFrame:
    """New files of a raw table as a stream."""
    table = TABLES[fv.BRONZE[source]]
    schema = T.StructType([*table.schema.fields, T.StructField(DAY, T.StringType())])
    reader = store.spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(store.path(table.name)).drop(DAY)


def start_silver(
    store: TableStore,
    checkpoint: str,
    sources: Iterable[str] = fv.SOURCES,
    max_files: int | None = None,
    gold: bool = True,
    strict: bool = False,
    checks: Mapping[str, cleaning.Cleaner] = cleaning.CHECKS,
    processing_time: str = "1 minute",
    available_now: bool = False,
    clock: Callable[[], str] = utc_now,
    on_batch: Callable[[int, list], None] | None = None,
) -> StreamingQuery:
    """Clean, upsert, join and (``gold``) score what arrives in the raw tables.

    ``on_batch`` gets the batch's number and its metrics, a row per source as ``flows.run_flow`` gives
    them.  A later batch's row replaces an earlier one's of the same key.
    """
    sources = list(sources)
    raw = [read_raw(store, source, max_files).withColumn(_OF, F.lit(source)) for source in sources]
    stream = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), raw)

    def write(batch: DataFrame, number: int) -> None:
        run_ts = clock()

        def clean(source: str) -> tuple[DataFrame, ...]:
            # The other sources' files are not read for it, as their rows name theirs as a constant.
            rows = batch.filter(F.col(_OF) == source).select(*TABLES[fv.BRONZE[source]].schema.fieldNames())
            return clean_source(store, source, rows, run_ts, strict, checks)[1:]

        done = side_by_side(batch.sparkSession, [partial(clean, source) for source in sources])
        touched, rejects, metrics = (reduce(DataFrame.union, parts) for parts in zip(*done))
        store.append("silver_rejects", rejects)
        refresh(store, run_ts, touched.distinct().checkpoint(), gold=gold)
        if on_batch:
            on_batch(number, metrics.collect())

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return writer.trigger(**trigger).start()
