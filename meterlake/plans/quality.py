"""Contract checks: keys, references, domains and schemas, each as ``check, table_name, violations``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.sources.lake import Lake, broken_rule
from meterlake.tables import REFERENCES, Table


def _report(counted: DataFrame, check: str, table_name: str) -> DataFrame:
    return counted.select(
        F.lit(check).alias("check"), F.lit(table_name).alias("table_name"), F.col("violations").cast("long")
    )


def duplicate_keys(rows: DataFrame, key: Sequence[str], table_name: str) -> DataFrame:
    """How many keys occur more than once."""
    repeated = rows.groupBy(*key).count().filter(F.col("count") > 1)
    return _report(repeated.agg(F.count("*").alias("violations")), "primary_key", table_name)


def orphans(child: DataFrame, parent: DataFrame, key: str, relation: str) -> DataFrame:
    """How many child rows name a key the parent lacks; a null key names nothing.

    The child is counted per key first, so the join sees a key once however often it occurs. An
    outer join keeps that order; an anti join would be pushed below the count by the optimizer.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(key, F.lit(True).alias("known"))
    missing = used.join(known, key, "left").filter(F.col("known").isNull())
    return _report(
        missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), "foreign_key", relation
    )


def outside_domains(rows: DataFrame, domains: Mapping[str, str], table_name: str) -> DataFrame:
    """Rows that break each condition, all conditions in one pass; null breaks a condition."""
    counts = rows.agg(*[broken_rule(rule).alias(name) for name, rule in domains.items()])
    long = counts.unpivot([], list(domains), "rule", "violations")
    return long.select(
        F.concat(F.lit("domain:"), "rule").alias("check"),
        F.lit(table_name).alias("table_name"),
        F.col("violations").cast("long"),
    )


def schema_differences(rows: DataFrame, table: Table) -> list[str]:
    """Columns that are missing, additional or of another type than declared."""
    found = {f.name: f.dataType for f in rows.schema}
    declared = {c.name: c.type for c in table.columns}
    problems = [f"{name} is missing" for name in declared if name not in found]
    problems += [f"{name} is not declared" for name in found if name not in declared]
    problems += [
        f"{name} is {found[name].simpleString()}, declared {declared[name].simpleString()}"
        for name in declared
        if name in found and found[name] != declared[name]
    ]
    return problems


def check(lake: Lake) -> DataFrame:
    """Every check the data dictionary declares, on the saved tables of a lake.

    Keys, domains and columns of each table, and references between tables that are both there.
    Bronze may have more columns than declared, so only missing ones count there. What the save of a version has
    counted or proven is taken from there; only what it left open is looked for in the table. Keys and references of
    tables bucketed by their meter are counted without a shuffle.
    """
    saved = lake.saved()
    parts, known = [], []
    for table in saved:
        rows, name, facts = lake.read(table), f"{table.layer}.{table.name}", lake.facts(table)
        problems = schema_differences(rows, table)
        if table.layer == "bronze":
            problems = [p for p in problems if p.endswith("is missing")]
        known.append(("schema", name, len(problems)))
        if table.key and facts.get("key") == "proven":
            known.append(("primary_key", name, 0))
        elif table.key:
            parts.append(duplicate_keys(rows, table.key, name))
        counted = {rule: facts.get(f"domain:{rule}") for rule in table.domains}
        known += [(f"domain:{rule}", name, n) for rule, n in counted.items() if n is not None]
        if uncounted := {rule: table.domains[rule] for rule, n in counted.items() if n is None}:
            parts.append(outside_domains(rows, uncounted, name))
    for child, parent, key in REFERENCES:
        if child in saved and parent in saved:
            parts.append(orphans(lake.read(child), lake.read(parent), key, f"{child.name} -> {parent.name}"))
    found = lake.spark.createDataFrame(known, "check string, table_name string, violations long")
    return reduce(DataFrame.unionByName, parts, found)
