"""Run counters that come with the rows: metrics observed while a result is written, so nothing is scanned or asked a second time.

``counted`` attaches the counters to a plan; once an action has run, ``Counters.row`` has them. In a stream the same counters come with
every batch, and ``Progress`` listens to them. Aggregates are Spark's own, combined over tasks and stages, and hold one row whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STATUSES = ("success", "failed", "skipped")


def counters(status: Column | str = "status", latency: Column | str | None = None, statuses: tuple[str, ...] = STATUSES, **more: Column) -> list[Column]:
    """rows, rows by status, and with ``latency`` its mean, over all and by status, and its maximum."""
    s = F.col(status) if isinstance(status, str) else status
    out = [F.count(F.lit(1)).alias("rows"), *(F.count_if(s == x).alias(x) for x in statuses)]
    if latency is not None:
        t = F.col(latency) if isinstance(latency, str) else latency
        out += [F.avg(t).alias("mean_latency"), F.max(t).alias("max_latency"), *(F.avg(F.when(s == x, t)).alias(f"mean_latency_{x}") for x in statuses)]
    return out + [c.alias(n) for n, c in more.items()]


class Counters:
    """Counters of one run of a plan."""

    def __init__(self, name: str = "run"):
        self._seen = Observation(name)

    def attach(self, df: DataFrame, *exprs: Column) -> DataFrame:
        return df.observe(self._seen, *exprs)

    @property
    def row(self) -> dict[str, object]:
        """The counters; waits for the first action on the plan."""
        return self._seen.get


def counted(df: DataFrame, *exprs: Column, name: str = "run") -> tuple[DataFrame, Counters]:
    """``df`` with counters attached, and where they will be."""
    c = Counters(name)
    return c.attach(df, *(exprs or counters())), c


class Progress(StreamingQueryListener):
    """Adds up the counters ``name`` of all batches of the streams it listens to: ``total`` sums counts, ``batches`` has each batch's."""

    def __init__(self, name: str = "run"):
        self.name, self.batches, self.total = name, [], {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        seen = (event.progress.observedMetrics or {}).get(self.name)
        if seen is not None:
            row = seen.asDict()
            self.batches.append(row)
            for k, v in row.items():
                if isinstance(v, int):
                    self.total[k] = self.total.get(k, 0) + v

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
