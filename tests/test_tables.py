"""Stored tables without days before their first version."""

from skybasin import fixed_values as fv
from skybasin.schemas import TABLES
from skybasin.session import working_dir
from skybasin.sources.tables import TableStore


def test_table_without_days_before_its_first_version(spark):
    # No create_all: the first append, upsert and read find no version yet.
    store = TableStore(spark, working_dir(spark, "fresh"))
    table = TABLES[fv.DIM_LOCATION]
    assert store.read(fv.DIM_LOCATION).count() == 0
    assert store.read(fv.DIM_LOCATION).schema == table.schema
    rows = spark.createDataFrame([], table.schema)
    store.append(fv.DIM_LOCATION, rows)
    assert store.read(fv.DIM_LOCATION).count() == 0
    other = TableStore(spark, working_dir(spark, "fresh"))
    other.upsert(fv.DIM_LOCATION, rows)
    assert other.read(fv.DIM_LOCATION).count() == 0
