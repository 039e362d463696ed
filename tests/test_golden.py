"""Known answers on the given tables."""

from pathlib import Path

import pytest

from tidemark.queries import logs
from tidemark.queries.joins import tpch_q5_local_supplier
from tidemark.queries.temporal import EARLY, LATER, NOW

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.mark.parametrize("log,versions,current,early,later", [
    (logs.events_log, 7986, 120, 115, 120), (logs.late_log, 618, 129, 121, 124)])
def test_event_versions(spark, log, versions, current, early, later):
    table = log(spark, SF_DIR).columns("event_type")
    assert table.all_versions().count() == versions
    assert table.current(NOW).count() == current
    assert (table.as_of(EARLY).count(), table.as_of(LATER).count()) == (early, later)


def test_local_supplier_volume(spark):
    got = [tuple(r) for r in tpch_q5_local_supplier(spark, SF_DIR).collect()]
    assert len(got) == 5
    assert got[:2] == [("NATION_7", 1578427.17), ("NATION_2", 1205371.19)]
