"""Row counts that come with the jobs that already run (A2).

A job reports how many rows it read, rejected, trained on and wrote. Each number is an
observed metric of the frame it describes (``DataFrame.observe``): Spark fills it in while
some action runs over the frame for its own purpose, so no extra job counts anything.

Cases: an empty frame counts zero. A null condition does not count. A frame whose rows are
read several times is counted by its first finished action. Counts are accumulators: a
shuffle map task that runs again after a lost executor may be counted twice, so they are
for reports; no result is computed from them.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WAIT_SECONDS = 60.0


class RowCounts:
    """Named counts of the frames that a job passes through ``watch``."""

    def __init__(self) -> None:
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, **conditions: Column) -> DataFrame:
        """``df`` itself; once an action has run over all of it, ``get`` has the number
        of rows that meet each condition under the key ``step.name``."""
        if any(step == known for known, _ in self._watched):
            raise ValueError(f"step {step!r} is counted already")
        seen = Observation()
        self._watched.append((step, seen))
        return df.observe(seen, *[F.count_if(c).alias(name) for name, c in conditions.items()])

    def get(self, wait: float = WAIT_SECONDS) -> dict[str, int]:
        """All counts, to be called after the job's actions. Metrics arrive by Spark's
        listener shortly after an action ends; a step that no action ran over is an error
        after ``wait`` seconds, not an endless wait."""
        out: dict[str, int] = {}
        for step, seen in self._watched:
            found: list[dict[str, int]] = []
            reader = threading.Thread(target=lambda: found.append(seen.get), daemon=True)
            reader.start()
            reader.join(wait)
            if not found:
                raise RuntimeError(f"no finished action ran over the rows of step {step!r}")
            out.update({f"{step}.{name}": n for name, n in found[0].items()})
        return out
