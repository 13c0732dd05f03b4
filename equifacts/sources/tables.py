"""Stored tables as bucketed Parquet folders, and the export sinks.

A table is split into hash buckets of its first key column, by Spark's own bucketing. A version
holds the buckets that it rewrites; the store's log says which version of each bucket counts, and
one commit may list versions of several tables, so a reader sees all of a change or nothing.

Changes are applied as changed rows. What is stored is joined with them bucket by bucket, as a
bucketed table of the session's catalog, so only the changed rows are shuffled. Buckets without a
changed row are not written, and a change without rows leaves neither a file nor a commit. The
number of buckets is fixed for a table's life: choose it so that one bucket is a few gigabytes. One
writer per store at a time; a commit that another one came before is refused.

Records of runs are kept apart: each run has a folder of its own, which it replaces as a whole.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from equifacts.functions.text import stamp_text
from equifacts.operators.quality import Rule, broken_rules
from equifacts.operators.upsert import CHANGED, DIRTY, OP, upsert
from equifacts.schemas import KEYS, TABLES
from equifacts.session import stage
from equifacts.sources.commits import CommitLog, State

PARTITIONS = StructType([StructField("version", LongType()), StructField("bucket", IntegerType())])
AUDIT = [StructField(OP, StringType()), StructField(CHANGED, ArrayType(StringType()))]
DELETE = "delete"
QUARANTINE = "name string, rule string, key string, row string"


class Tables:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 256, layouts=TABLES,
                 keys=KEYS, rules: list[Rule] | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.layouts, self.keys, self.rules = layouts, keys, rules or []
        self.log = CommitLog(spark, f"{self.root}/log")
        self._pending: list[tuple] | None = None
        self._state: State | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """Create the record tables that are missing; a bucketed one begins with its first commit."""
        for name, layout in self.layouts.items():
            if name not in self.keys and not self._exists(self.path(name)):
                self.spark.createDataFrame([], layout).write.parquet(self.path(name))

    def bucket_of(self, name: str) -> Column:
        """As Spark's bucketing puts the key."""
        return F.pmod(F.hash(self.keys[name][0]), F.lit(self.buckets)).cast("int")

    def touched(self, name: str, incoming: DataFrame) -> list[int]:
        """Buckets that hold a key of ``incoming``: at most ``buckets`` numbers."""
        found = incoming.select(self.bucket_of(name).alias("bucket")).distinct()
        return sorted(r.bucket for r in found.collect())

    def read(self, name: str, only: list[int] | None = None) -> DataFrame:
        """The newest version, of all buckets or of the given ones."""
        layout = self.layouts[name]
        if name not in self.keys:
            stored = self.spark.read.schema(layout).parquet(self.path(name))
            return stored.select(*layout.fieldNames())
        versions = self._versions(name, only)
        if not versions:
            return self.spark.createDataFrame([], layout)
        wanted = F.lit(False)
        for version in set(versions.values()):
            buckets = [b for b, v in versions.items() if v == version]
            wanted = wanted | ((F.col("version") == version) & F.col("bucket").isin(buckets))
        # Version and bucket are folders, so the filter prunes files before the scan.
        stored = self._scan(name, [*layout.fields, AUDIT[0]], sorted(set(versions.values())))
        return self._living(stored.where(wanted)).select(*layout.fieldNames())

    @contextmanager
    def aligned(self, name: str, only: list[int] | None = None) -> Iterator[DataFrame]:
        """The same rows as a bucketed table, which a join on the key need not shuffle.

        The catalog knows it until the block is left, so use it up inside.
        """
        fields = [*self.layouts[name].fields, AUDIT[0]]
        view = f"equifacts_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE {view} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) "
            f"CLUSTERED BY (`{self.keys[name][0]}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}/unlisted'")
        try:
            parts = [f"PARTITION (bucket={b}) LOCATION '{self._data_path(name)}/version={v}/bucket={b}'"
                     for b, v in self._versions(name, only).items()]
            if parts:
                self.spark.sql(f"ALTER TABLE {view} ADD {' '.join(parts)}")
            yield self._living(self.spark.table(view)).select(*self.layouts[name].fieldNames())
        finally:
            self.spark.sql(f"DROP TABLE {view}")

    def _living(self, rows: DataFrame) -> DataFrame:
        """Without the rows that a version keeps only to tell that it deleted them."""
        return rows.where(F.col(OP).isNull() | (F.col(OP) != DELETE))

    def _scan(self, name: str, fields: list[StructField], versions: list[int]) -> DataFrame:
        """The folders of the given versions; older ones are not even listed."""
        data = self._data_path(name)
        reader = self.spark.read.schema(StructType([*fields, *PARTITIONS.fields]))
        return reader.option("basePath", data).parquet(
            *[f"{data}/version={version}" for version in versions])

    # Changes: rows of a table with OP and CHANGED, of which only those to be written are there.

    def upserted(self, name: str, incoming: DataFrame, values: list[str], run_ts, **how) -> DataFrame:
        """The rows of a table that an upsert writes, staged: new ones, and ones it alters."""
        with self.aligned(name, self.touched(name, incoming)) as stored:
            result = upsert(stored, incoming, self.keys[name], values, run_ts, **how)
            return stage(result.where(DIRTY).drop(DIRTY), f"changes-{name}")

    def replaced(self, name: str, incoming: DataFrame, processed: DataFrame | None = None) -> DataFrame:
        """The rows that replacing all rows of each processed key writes or deletes, staged.

        Without ``processed``, the keys with incoming rows are the processed ones. Rows that
        stay as they are, are no changes.
        """
        keys, lead = self.keys[name], self.keys[name][0]
        mine = (incoming if processed is None else processed).select(lead).distinct()
        values = [f for f in self.layouts[name].fieldNames() if f not in keys]
        new = incoming.select(*keys, F.struct(*values).alias("new"), F.lit(True).alias("given"))
        with self.aligned(name, self.touched(name, mine)) as stored:
            old = stored.join(mine, lead, "left_semi").select(
                *keys, F.struct(*values).alias("old"), F.lit(True).alias("stored"))
            both = old.join(new, keys, "full_outer")
            op = F.when(F.col("given").isNull(), DELETE).when(F.col("stored").isNull(), "insert").when(
                ~F.col("new").eqNullSafe(F.col("old")), "update")
            row = F.when(F.col("given").isNull(), F.col("old")).otherwise(F.col("new"))
            return stage(both.select(*keys, row.alias("row"), op.alias(OP)).where(F.col(OP).isNotNull()).select(
                *keys, "row.*", OP, F.array().cast("array<string>").alias(CHANGED)), f"changes-{name}")

    def removed(self, name: str, gone: DataFrame, key: str) -> DataFrame:
        """The stored rows of the keys that are gone, as deletions, staged."""
        mine = gone.select(key).distinct()
        with self.aligned(name, self.touched(name, mine)) as stored:
            return stage(stored.join(mine, key, "left_semi").withColumns({
                OP: F.lit(DELETE), CHANGED: F.array().cast("array<string>")}), f"changes-{name}")

    def remove(self, gone: DataFrame, key: str, **how) -> dict[str, int]:
        """Delete keys from every table that leads with ``key``, parents and children at once."""
        return self.apply({n: self.removed(n, gone, key) for n, k in self.keys.items() if k[0] == key}, **how)

    def apply(self, changes: dict[str, DataFrame], writer: str | None = None,
              epoch: int | None = None) -> dict[str, int]:
        """Write the changed rows of several tables, in one commit; gives the version of each.

        Rows that break a rule go to the quarantine with the rule's name instead. A table without
        changed rows keeps its versions; the number given for it is then one that is not listed.
        """
        self._state, self._pending = self.log.state(), []
        seen = self._state.commit
        try:
            good = self._enforced(changes, seen + 1)
            versions = {}
            for name, rows in good.items():
                versions[name] = self.next_version(name)
                # Decided before anything is written: a count for each bucket with changes.
                counts = rows.groupBy(self.bucket_of(name).alias("bucket")).count().collect()
                buckets = sorted(r.bucket for r in counts)
                if buckets:
                    with self.aligned(name, buckets) as stored:
                        self.publish(name, self._merged(name, stored, rows), versions[name], buckets)
            if self._pending:
                self.log.append(self._pending, seen, writer, epoch)
            return versions
        finally:
            self._pending = self._state = None

    def _merged(self, name: str, stored: DataFrame, rows: DataFrame) -> DataFrame:
        """What is stored with the changed rows in place of the old ones.

        Each task of the join holds one bucket, which it then writes.
        """
        keys = self.keys[name]
        values = [f for f in self.layouts[name].fieldNames() if f not in keys]
        old = stored.select(*keys, F.struct(*values).alias("old"))
        new = rows.select(*keys, F.struct(*values).alias("new"), OP, CHANGED, F.lit(True).alias("given"))
        row = F.when(F.col("given"), F.col("new")).otherwise(F.col("old"))
        return old.join(new, keys, "full_outer").select(*keys, row.alias("row"), OP, CHANGED).select(
            *keys, "row.*", OP, CHANGED)

    def _enforced(self, changes: dict[str, DataFrame], commit: int) -> dict[str, DataFrame]:
        """The changes that keep every rule; the others are written to the quarantine."""
        if not any(r.table in changes for r in self.rules):
            return changes
        good, bad = dict(changes), []
        # Parents before their children: a child of a quarantined parent has no parent.
        for rule_table in self._parents_first(changes):
            rules = [r for r in self.rules if r.table == rule_table]
            if not rules:
                continue
            parents = {r.parent: self._keys_after(r.parent, r.parent_key, good) for r in rules if r.parent}
            judged = stage(broken_rules(changes[rule_table], rules, parents, OP, DELETE), f"judged-{rule_table}")
            good[rule_table] = judged.where(F.size("broken") == 0).drop("broken")
            key = F.to_json(F.struct(*self.keys[rule_table]))
            row = F.to_json(F.struct(*self.layouts[rule_table].fieldNames()))
            bad.append(judged.select(
                F.lit(rule_table).alias("name"), F.explode("broken").alias("rule"), key.alias("key"), row.alias("row")))
        if bad:
            rows = bad[0]
            for more in bad[1:]:
                rows = rows.unionByName(more)
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(f"{self.path('quarantine')}/commit={commit}")
                self._pending.append(("quarantine", commit, commit))
        return good

    def _parents_first(self, changes) -> list[str]:
        order: list[str] = []

        def visit(name):
            for rule in self.rules:
                if rule.table == name and rule.parent in changes and rule.parent != name:
                    visit(rule.parent)
            if name not in order:
                order.append(name)

        for name in changes:
            visit(name)
        return order

    def _keys_after(self, name: str, key: str, changes: dict[str, DataFrame]) -> DataFrame:
        """The keys a table has when the changes are in."""
        stored = self.read(name).select(key)
        if name not in changes:
            return stored.distinct()
        rows = changes[name].select(key, OP)
        return stored.join(rows.where(F.col(OP) == DELETE).select(key), key, "left_anti").union(
            rows.where(F.col(OP) != DELETE).select(key)).distinct()

    def quarantine(self) -> DataFrame:
        """Rows that broke a rule, as JSON, with the rule's name and the commit that left them out."""
        commits = sorted(set(self._versions("quarantine").values()))
        layout = StructType.fromDDL(QUARANTINE).add("commit", LongType())
        if not commits:
            return self.spark.createDataFrame([], layout)
        folder = self.path("quarantine")
        return self.spark.read.schema(layout).option("basePath", folder).parquet(
            *[f"{folder}/commit={c}" for c in commits])

    def publish(self, name: str, result: DataFrame, version: int, only: list[int],
                writer: str | None = None, epoch: int | None = None) -> None:
        """Write all rows of the given buckets as ``version``; inside ``apply``, listed at its end.

        ``result`` may carry the operation and changed columns of an upsert; they are
        stored beside the data so that ``changes`` need not compute the join again.
        A version that the log already lists is not written twice.
        """
        if not only or self.has_version(name, version):
            return
        audit = [F.col(f.name) if f.name in result.columns else F.lit(None).cast(f.dataType).alias(f.name)
                 for f in AUDIT]
        rows = result.select(*self.layouts[name].fieldNames(), *audit, self.bucket_of(name).alias("bucket"))
        if self._pending is None:
            rows = rows.repartition(self.buckets, self.keys[name][0])
        view = f"equifacts_{uuid.uuid4().hex}"
        try:
            rows.write.mode("overwrite").partitionBy("bucket").bucketBy(self.buckets, self.keys[name][0]).option(
                "path", f"{self._data_path(name)}/version={version}").saveAsTable(view)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {view}")  # its files stay
        entries = [(name, bucket, version) for bucket in only]
        if self._pending is None:
            self.log.append(entries, self.log.state().commit, writer, epoch)
        else:
            self._pending += entries

    def changes(self, name: str, version: int) -> DataFrame:
        """Change log of a published version, read from what was written."""
        keys = self.keys[name]
        fields = [f for f in self.layouts[name] if f.name in keys]
        if self.has_version(name, version):
            stored = self._scan(name, [*fields, *AUDIT], [version])
        else:
            stored = self.spark.createDataFrame([], StructType([*fields, *AUDIT]))
        logged = stored.where(F.col(OP).isin("insert", "update", DELETE))
        return logged.select(*keys, F.col(OP).alias("op"), F.col(CHANGED).alias("changed"))

    def replace_run(self, name: str, run_id: str, rows: DataFrame) -> None:
        """Write all rows that a run leaves in a table of records; a repeated run replaces them."""
        fields = [f for f in self.layouts[name].fieldNames() if f != "run_id"]
        rows.select(*fields).write.mode("overwrite").parquet(
            f"{self.path(name)}/run_id={quote(run_id, safe='')}")

    def has_version(self, name: str, version: int) -> bool:
        """Versions of a table grow, so those up to the newest are or were listed."""
        return version < self.next_version(name)

    def has_epoch(self, writer: str, epoch: int) -> bool:
        return self.log.state().epochs.get(writer, -1) >= epoch

    def next_version(self, name: str) -> int:
        return max(self._versions(name).values(), default=0) + 1

    def _versions(self, name: str, only: list[int] | None = None) -> dict[int, int]:
        found = (self._state or self.log.state()).versions.get(name, {})  # one state within ``apply``
        return {b: v for b, v in found.items() if only is None or b in only}

    def _data_path(self, name):
        return f"{self.path(name)}/data"

    def _exists(self, path: str) -> bool:
        try:
            self.spark.read.format("binaryFile").load(path).limit(0).schema
            return True
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return False
            raise


def write_csv(tables: dict[str, DataFrame], folder: str) -> list[str]:
    """One CSV folder per table that has rows; empty tables leave no file."""
    written = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
        shown = df.withColumns({s: stamp_text(F.col(s)) for s in stamps}) if stamps else df
        shown.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
        written.append(name)
    return written


def write_reports(reports: dict[str, DataFrame], folder: str, run_id: str,
                  fmt: str = "parquet") -> None:
    """Each report under ``report=<name>/run_id=<id>``."""
    for name, df in reports.items():
        slug = name.lower().replace(" & ", "_").replace(" ", "_")
        writer = df.write.mode("overwrite").option("header", True)
        writer.format(fmt).save(f"{folder}/report={slug}/run_id={run_id}")
