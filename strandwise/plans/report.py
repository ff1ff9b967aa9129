"""Counters and times of a run."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strandwise import schema as S
from strandwise.functions import fields as X
from strandwise.operators import duplicates as D
from strandwise.sources.text import parse, scan_records


class Report:
    """Wall time of named steps, and counters that their jobs observe."""

    def __init__(self):
        self.took: dict[str, float] = {}
        self._seen: list[Observation] = []

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        began = time.perf_counter()
        try:
            yield
        finally:
            self.took[name] = self.took.get(name, 0.0) + time.perf_counter() - began

    def counted(self, df: DataFrame, **counters) -> DataFrame:
        """`df`, whose first action takes the counters along."""
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *(c.cast("long").alias(n) for n, c in counters.items()))

    def counters(self) -> dict[str, int]:
        return {n: v or 0 for seen in self._seen for n, v in seen.get.items()}

    def times(self, spark: SparkSession) -> DataFrame:
        """(step, ms, percent), in the order of the steps."""
        total = sum(self.took.values()) or 1.0
        return spark.createDataFrame([(n, int(1000 * s), 100 * s / total) for n, s in self.took.items()], "step string, ms long, percent double")


def run_counters(lines: DataFrame, policy: str = S.COMPAT) -> DataFrame:
    """(metric, value): lines, headers, records, dropped lines and duplicates of a marking run.

    The text is scanned once: all but the duplicates are observed while the parsed records are written."""
    report = Report()
    one = F.lit(1)
    seen = report.counted(lines, lines=F.count(one), headers=F.count_if(X.is_header(F.col("line"))))
    parsed = report.counted(parse(scan_records(seen)), dropped=F.count_if(F.col("n_fields") < S.MIN_FIELDS), records=F.count_if(F.col("n_fields") >= S.MIN_FIELDS))
    duplicates = D.mark_duplicates(D.records(parsed), policy).agg(F.count_if("is_dup")).first()[0]
    found = report.counters() | {"duplicates": duplicates}
    return lines.sparkSession.createDataFrame(sorted(found.items()), "metric string, value long")
