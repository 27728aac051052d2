"""Row counts at named points of a step, taken while the step's own write runs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# (rows, name of the point, whether the rows that came before it are kept or dropped and nothing else)
Tap = Callable[..., DataFrame]


def no_tap(df: DataFrame, point: str, filters: bool = True) -> DataFrame:
    """Counts nothing: the plan is the one without taps."""
    return df


@dataclass(frozen=True)
class Count:
    step: str
    point_no: int
    point: str
    row_cnt: int
    dropped_cnt: int | None  # of the point before; None for a first point and where rows multiply or merge


class StepLedger:
    """Counts the rows that pass named points of a warehouse step.

    ``tap(step)`` gives the function a job calls at its points. A point is an observed metric
    (``DataFrame.observe``) of the plan the job writes, so counting needs no job and no scan of its own;
    it takes the place of separate counts before and after each cleaning step. A filter can't be pushed
    below a point, so a job's plan without a ledger has none.

    A count is of the rows that the tasks handled: a stage run again because an executor was lost may count
    some rows twice. ``rows`` must be asked after the step's write; a step that was not written has none.
    """

    def __init__(self) -> None:
        self._points: dict[str, list[tuple[str, bool, Observation]]] = {}
        self._written: dict[str, list[Count]] = {}

    def tap(self, step: str) -> Tap:
        points = self._points[step] = []

        def at(df: DataFrame, point: str, filters: bool = True) -> DataFrame:
            seen = Observation(f"{step}/{len(points)}")
            points.append((point, filters, seen))
            return df.observe(seen, F.count(F.lit(1)).alias("row_cnt"))

        return at

    def written(self, step: str) -> None:
        """Take the counts of a step whose write has ended."""
        found, before = [], None
        for k, (point, filters, seen) in enumerate(self._points.pop(step, [])):
            n = int(seen.get["row_cnt"])
            found.append(Count(step, k, point, n, before - n if filters and before is not None else None))
            before = n
        self._written[step] = found

    @property
    def rows(self) -> list[Count]:
        return [c for step in self._written.values() for c in step]

    def table(self, spark: SparkSession) -> DataFrame:
        """The counts as a table: one row for each point of each written step."""
        rows = [(c.step, c.point_no, c.point, c.row_cnt, c.dropped_cnt) for c in self.rows]
        return spark.createDataFrame(rows, "step string, point_no int, point string, row_cnt long, dropped_cnt long")
