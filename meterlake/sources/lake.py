"""The layered table store: ingest, save, read, list, audit.

A saved table is a view. Every save writes a version, a table of its own in a schema beside the layer, and then points
the view at it in one catalog call: a reader sees the old version or the new one, and a save that fails at any point
leaves the old one. What was found while writing (rows, broken rules, whether the plan proves the key) stands in the
view's properties and so always belongs to the version it names.
"""

from __future__ import annotations

import contextlib
import datetime
import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.config import LAYERS, LakeConfig
from meterlake.sources.csv_files import MALFORMED, read_csv, read_csv_if_present, with_lineage
from meterlake.sources.scratch import remove_folder
from meterlake.tables import TABLES, Table

_VERSION = "version-"
_FACTS, _CURRENT = "meterlake.facts", "meterlake.version"

AUDIT_COLUMNS = (
    "run_id string, layer string, table_name string, status string, "
    "row_count long, column_count int, malformed_rows long, finished_at timestamp"
)


def broken_rule(rule: str) -> Column:
    """How many rows break a rule; null breaks it."""
    return F.count_if(~F.coalesce(F.expr(rule), F.lit(False)))


def proven_unique(rows: DataFrame, key: Sequence[str]) -> bool:
    """Whether the plan of the rows groups by columns of the key, or is otherwise known to give each key once.

    Catalyst derives this for its own rules; a session without a local plan proves nothing.
    """
    plan = getattr(rows, "_jdf", None)
    if plan is None or not key:
        return False
    optimized = plan.queryExecution().optimizedPlan()
    columns = {a.exprId().toString(): a.name() for a in _elements(optimized.output())}
    for unique in _elements(optimized.distinctKeys()):
        parts = _elements(unique)
        if all(e.getClass().getSimpleName() == "AttributeReference" for e in parts):
            if {columns.get(e.exprId().toString()) for e in parts} <= set(key):
                return True
    return False


def _elements(found) -> list:
    each = found.iterator()
    items = []
    while each.hasNext():
        items.append(each.next())
    return items


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while; an insert takes this one from nowhere else."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Lake:
    """Tables of one namespace. Every save is a full overwrite, so a run can be repeated."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark = spark
        self.config = config
        self.run_id = uuid.uuid4().hex
        self._audit: list[tuple] = []

    def create_schemas(self) -> None:
        for layer in LAYERS:
            for schema in (self.config.schema(layer), self.config.versions(layer)):
                self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")

    def create_tables(self) -> None:
        """The declared tables, empty, where they do not exist yet."""
        self.create_schemas()
        for table in TABLES:
            if not self.spark.catalog.tableExists(self.config.table(table.layer, table.name)):
                self._replace(self.spark.createDataFrame([], table.schema), table, {})

    def read(self, table: Table) -> DataFrame:
        return self.spark.table(self.config.table(table.layer, table.name))

    def read_days(self, table: Table, first: datetime.date, last: datetime.date) -> DataFrame:
        """The rows of some days; of a table partitioned by month only the folders of their months are listed and read."""
        days = self.read(table).filter(F.col("day").between(F.lit(first), F.lit(last)))
        if "year_month" not in table.partitioned_by:
            return days
        return days.filter(F.col("year_month").between(first.year * 100 + first.month, last.year * 100 + last.month))

    def save(self, rows: DataFrame, table: Table) -> DataFrame:
        """Overwrite a table and return a scan of it; its rows and broken rules are counted by the write itself.

        Silver and gold rows are brought to the declared columns and types, and fail if they
        cannot be. Bronze keeps whatever the file had; declared columns it lacks are named in the audit.
        """
        status = "saved"
        if table.layer != "bronze":
            rows = rows.to(table.schema)
        elif absent := [c.name for c in table.columns if c.name not in rows.columns]:
            status = f"saved without {', '.join(absent)}"
        metrics = [F.count(F.lit(1)).alias("rows"), *[broken_rule(rule).alias(f"domain:{name}") for name, rule in table.domains.items()]]
        if MALFORMED in rows.columns:
            metrics.append(F.count(MALFORMED).alias("malformed"))
        proven = proven_unique(rows, table.key)
        observed = Observation(f"{table.layer}.{table.name}")
        facts = lambda: {**observed.get, "key": "proven" if proven else "open"}  # noqa: E731  known once the rows are written
        self._replace(rows.observe(observed, *metrics), table, facts)
        counted = observed.get
        self._note(table, status, counted["rows"], len(rows.columns), counted.get("malformed"))
        return self.read(table)

    def save_partitions(self, rows: DataFrame, table: Table, named: Sequence[tuple]) -> DataFrame:
        """Replace the named partitions within the version that is there; the files of others stay as they are.

        ``named`` are values of the partition columns; rows of other partitions are left out, and a named partition
        without rows is empty afterwards. What was found while writing the version holds no longer and is forgotten, so checks
        count again. A reader of just these partitions may find its files gone; readers of others see nothing of it.
        """
        version = self.current_version(table)
        if not table.partitioned_by or version is None:
            raise ValueError(f"{table.layer}.{table.name} has no saved partitions")
        wanted = F.struct(*table.partitioned_by).isin([F.struct(*map(F.lit, values)) for values in named])
        self._forget(table)
        observed = Observation(f"{table.layer}.{table.name}")
        each = [F.count_if(F.struct(*table.partitioned_by) == F.struct(*map(F.lit, values))).alias(f"part_{k}") for k, values in enumerate(named)]
        found = rows.to(table.schema).filter(wanted).observe(observed, F.count(F.lit(1)).alias("rows"), *each)
        with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            self._laid_out(found, table).write.mode("overwrite").insertInto(version)
        for k, values in enumerate(named):
            if not observed.get[f"part_{k}"]:
                spelled = "/".join(f"{c}={v}" for c, v in zip(table.partitioned_by, values))
                remove_folder(self.spark, f"{self._folder(version)}/{spelled}")
        self.spark.catalog.refreshTable(version)
        self._note(table, "partitions saved", observed.get["rows"], len(table.columns), None)
        return self.read(table)

    def _folder(self, version: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {version}").filter("col_name = 'Location'")
        return described.first().data_type

    def _laid_out(self, rows: DataFrame, table: Table) -> DataFrame:
        """Equal bucket values in one task, so that a bucket is one file; partitions come laid out by their plan."""
        if table.bucketed_by is None:
            return rows
        return rows.repartition(self.config.buckets, table.bucketed_by).sortWithinPartitions(table.bucketed_by)

    def _replace(self, rows: DataFrame, table: Table, facts) -> None:
        """Write a version and point the table's name at it; ``facts`` are asked for in between."""
        name, path = self.config.table(table.layer, table.name), self.config.location(table.layer, table.name)
        if self.config.table_format == "delta":
            writer = rows.write.format("delta").mode("overwrite").option("overwriteSchema", "true")
            (writer.option("path", path) if path else writer).saveAsTable(name)
            return
        now = datetime.datetime.now(datetime.timezone.utc)
        version = f"{table.name}__{now:%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
        stored = f"{self.config.versions(table.layer)}.{version}"
        writer = self._laid_out(rows, table).write.format(self.config.table_format).partitionBy(*table.partitioned_by)
        if table.bucketed_by:
            writer = writer.bucketBy(self.config.buckets, table.bucketed_by).sortBy(table.bucketed_by)
        (writer.option("path", f"{path}/{_VERSION}{version}") if path else writer).saveAsTable(stored)
        self._point(table, stored, facts() if callable(facts) else facts)
        self._drop_old_versions(table, version)

    def _point(self, table: Table, stored: str, facts: dict) -> None:
        """Name a version: the one step that readers see."""
        name = self.config.table(table.layer, table.name)
        comments = {c.name: c.comment for c in table.columns}
        columns = ", ".join(
            f"`{c}`" + (f" COMMENT {_quoted(comments[c])}" if comments.get(c) else "") for c in self.spark.table(stored).columns
        )
        properties = f"'{_CURRENT}' = {_quoted(stored)}, '{_FACTS}' = {_quoted(json.dumps(facts))}"
        command = f"VIEW {name} ({columns}) COMMENT {_quoted(table.comment)} TBLPROPERTIES ({properties}) AS SELECT * FROM {stored}"
        try:
            self.spark.sql(f"CREATE OR REPLACE {command}")
        except AnalysisException as error:
            if error.getCondition() != "EXPECT_VIEW_NOT_TABLE.NO_ALTERNATIVE":
                raise
            # the name was saved as a table once; only this first time it is gone for a moment
            self.spark.sql(f"DROP TABLE {name}")
            self.spark.sql(f"CREATE {command}")

    def _properties(self, table: Table) -> dict[str, str]:
        name = self.config.table(table.layer, table.name)
        if not self.spark.catalog.tableExists(name):
            return {}
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}

    def current_version(self, table: Table) -> str | None:
        """The table behind a name."""
        return self._properties(table).get(_CURRENT)

    def facts(self, table: Table) -> dict:
        """What the save of the current version found: rows, malformed, domain:..., and the key (proven or open)."""
        return json.loads(self._properties(table).get(_FACTS, "{}"))

    def _forget(self, table: Table) -> None:
        self._point(table, self.current_version(table), {})

    def _drop_old_versions(self, table: Table, current: str) -> None:
        """Drop the versions before the last replaced ones, and what failed saves before them have left."""
        listed = self.spark.sql(f"SHOW TABLES IN {self.config.versions(table.layer)} LIKE '{table.name}__*'").filter("NOT isTemporary")
        older = sorted(r.tableName for r in listed.collect() if r.tableName.rpartition("__")[0] == table.name and r.tableName < current)
        path = self.config.location(table.layer, table.name)
        for version in older[: max(len(older) - self.config.kept_versions, 0)]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.config.versions(table.layer)}.{version}")
            if path:
                remove_folder(self.spark, f"{path}/{_VERSION}{version}")

    def ingest(
        self, source: str, table: Table, schema: StructType | None = None, optional: bool = False, **options
    ) -> DataFrame | None:
        """Land a source in bronze as it is; an optional source may be absent."""
        path = self.config.source_path(source)
        read = read_csv_if_present if optional else read_csv
        scan = read(self.spark, path, schema, **options)
        if scan is None:
            self._note(table, "skipped", None, None, None)
            return None
        return self.save(with_lineage(scan), table)

    def tables(self, layer: str) -> list[str]:
        listed = self.spark.catalog.listTables(self.config.schema(layer))
        return sorted(t.name for t in listed if not t.isTemporary)

    def saved(self) -> list[Table]:
        """The declared tables that are there."""
        present = {layer: set(self.tables(layer)) for layer in LAYERS}
        return [table for table in TABLES if table.name in present[table.layer]]

    def preview(self, table: Table, rows: int = 5) -> DataFrame:
        return self.read(table).limit(rows)

    def register_views(self, layer: str = "gold") -> None:
        """Name every saved table of a layer as a temporary view, for SQL over short names."""
        for table in self.saved():
            if table.layer == layer:
                self.read(table).createOrReplaceTempView(table.name)

    def define_view(self, name: str, sql: str, comment: str, layer: str = "gold") -> None:
        """A lasting view beside the tables of a layer; in the SQL, ``{table}`` stands for the full name of a table there."""
        names = {t.name: self.config.table(t.layer, t.name) for t in TABLES if t.layer == layer}
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.config.table(layer, name)} COMMENT {_quoted(comment)} AS {sql.format(**names)}")

    def _note(self, table: Table, status: str, rows: int | None, columns: int | None, malformed: int | None) -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        self._audit.append((self.run_id, table.layer, table.name, status, rows, columns, malformed, now))

    def write_audit(self) -> DataFrame:
        """Append what this run saved and skipped to the audit table, once per run."""
        notes = self.spark.createDataFrame(self._audit, AUDIT_COLUMNS).coalesce(1)
        writer = notes.write.format(self.config.table_format).mode("append")
        if path := self.config.location("gold", "audit"):
            # also takes over files of a table that a new catalog does not know yet
            writer = writer.option("path", path)
        writer.saveAsTable(self.config.table("gold", "audit"))
        self._audit = []
        return self.spark.table(self.config.table("gold", "audit"))
