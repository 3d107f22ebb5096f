"""Data checks taken while the mart is computed, without a scan of their own.

``DataFrame.observe`` counts rows that pass by a point of the plan.  All points
are behind the filters and groupings of the mart, so no filter is kept from
its scan, and what is counted are the few grouped rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Checks:
    """Collects observations of one run; ``report`` waits for the action that fills them."""

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watch(self, df: DataFrame, **metrics: Column) -> DataFrame:
        own = Observation()
        self._observed.append(own)
        return df.observe(own, *[c.alias(name) for name, c in metrics.items()])

    def report(self) -> dict[str, int]:
        """What the run met:

        completed      completed departures
        unmatched      those whose airport code has no airport (they are not in the mart)
        repeated       departures counted again because their airport code is listed several times
        rows           rows of the mart
        without_day    rows whose day is unknown
        without_name   rows of airports without a usable name
        """
        found: dict[str, int] = {}
        for one in self._observed:
            found.update({k: int(v or 0) for k, v in one.get.items()})
        found["repeated"] = found.pop("named") - found["completed"]
        return found


def total(column: str, when: Column | None = None) -> Column:
    return F.sum(F.col(column) if when is None else F.when(when, F.col(column)))
