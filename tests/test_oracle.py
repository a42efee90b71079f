"""Every query with SQL must match it. ORACLE_SF_DIR picks the data (default sf0.001)."""

import os

import pytest

import __spark_entry__ as contract
from oracle_check import compare, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# One pixel id occurs twice at sf0.001. Cell tables need one cell per pixel and layer, so
# queries that align cells run on the next size, where ids are unique.
ONE_CELL_PER_PIXEL = {
    "load_layers", "pixel_align", "pixel_table", "pixel_table_bucketed", "prepare_folder", "prepare_tables",
}
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def databases():
    found = {folder: duck(folder) for folder in (FOLDER, LARGER)}
    yield found
    for connection in found.values():
        connection.close()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, databases, name):
    folder = LARGER if name in ONE_CELL_PER_PIXEL else FOLDER
    got = contract.queries()[name](spark, folder).toPandas()
    want = databases[folder].execute(contract.oracle_sql()[name]).df()
    assert len(got) > 0
    assert compare(got, want) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 12


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
