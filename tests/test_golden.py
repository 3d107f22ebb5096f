"""End-to-end golden test: a small data set and its mart, worked out by hand."""

import pandas as pd

from tarmac import assemble_mart_from_metrics, daily_airport_mart
from tarmac.schemas import MART

from .fixtures import GOLDEN_EXPECTED, golden_tables


def _args(t):
    return (t["aircrafts_data"], t["airports_data"], t["bookings"], t["departures"], t["seats"],
            t["segments"], t["tickets"])


def test_fused_mart_matches_golden(spark):
    got = daily_airport_mart(*_args(golden_tables(spark)))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in MART]
    pd.testing.assert_frame_equal(pd.DataFrame(GOLDEN_EXPECTED), got.toPandas(), check_dtype=True)


def test_assembled_mart_matches_golden(spark):
    got = assemble_mart_from_metrics(*_args(golden_tables(spark)))
    pd.testing.assert_frame_equal(pd.DataFrame(GOLDEN_EXPECTED), got.toPandas(), check_dtype=True)
