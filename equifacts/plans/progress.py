"""What a run has finished, by stage and hash bucket, so that a repeated run goes on from there.

A stage's rows are built in waves of buckets. Each wave is written beside the others and then listed
in the run's log with its buckets; a run that ends early loses the wave it was in. When it is
repeated under its id, only buckets that no wave lists are built.
"""

import uuid
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equifacts.sources.commits import listed_files

LISTED = "place long, stage string, bucket int, part string"
RESET = "reset"


class Progress:
    def __init__(self, spark: SparkSession, root: str, run_id: str, buckets: int = 256, waves: int = 1,
                 fresh: bool = False):
        self.spark, self.buckets, self.waves = spark, buckets, max(1, min(waves, buckets))
        self.root = f"{root.rstrip('/')}/progress/run_id={quote(run_id, safe='')}"
        if fresh:
            self._list([(RESET, None, None)])

    def _rows(self) -> list:
        """Stages times buckets at most, and as many again for each fresh start."""
        folder = f"{self.root}/log"
        if not listed_files(self.spark, folder):
            return []
        rows = sorted(self.spark.read.schema(LISTED).parquet(folder).collect(), key=lambda r: r.place)
        last = max((k for k, r in enumerate(rows) if r.stage == RESET), default=-1)
        return rows[last + 1:]

    def _list(self, entries: list[tuple]) -> None:
        place = max((r.place for r in self._rows()), default=self._resets()) + 1
        self.spark.createDataFrame([(place, *e) for e in entries], LISTED).coalesce(1).write.mode(
            "append").parquet(f"{self.root}/log")

    def _resets(self) -> int:
        folder = f"{self.root}/log"
        if not listed_files(self.spark, folder):
            return 0
        return self.spark.read.schema(LISTED).parquet(folder).agg(F.max("place")).first()[0] or 0

    def bucket_of(self, key: str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets)).cast("int")

    def done(self, stage: str) -> dict[int, str]:
        """The finished buckets of a stage, and where the rows of each are."""
        return {r.bucket: r.part for r in self._rows() if r.stage == stage}

    def stage(self, name: str, source: DataFrame, key: str, build: Callable[[DataFrame], DataFrame],
              bucket: Column | None = None) -> DataFrame:
        """The rows that ``build`` makes of ``source``, of finished buckets as they were written.

        ``build`` is given the source rows of some buckets, and its rows carry their ``key``. Rows of
        keys that ``source`` does not have any more are left out.
        """
        bucket = self.bucket_of(key) if bucket is None else bucket
        todo = sorted(set(range(self.buckets)) - set(self.done(name)))
        size = -(-len(todo) // self.waves) if todo else 1
        for at in range(0, len(todo), size):
            wave = todo[at:at + size]
            # All of them: no filter, so that a run without an interruption has the plain plan.
            rows = source if len(wave) == self.buckets else source.where(bucket.isin(wave))
            part = f"{self.root}/stage={name}/{uuid.uuid4().hex}"
            build(rows).write.parquet(part)
            self._list([(name, b, part) for b in wave])
        stored = self.spark.read.parquet(*sorted(set(self.done(name).values())))
        return stored.join(source.select(key).distinct(), key, "left_semi")
