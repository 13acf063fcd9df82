"""Data checks: declared per table, counted in one pass over each, failing rows kept.

A scan turns each row into a mask of the row-level checks it breaks (not null, accepted values, expressions, email) and one
64-bit hash per key that has to be unique. Masks are few and combine map-side; hashes are
counted in the same shuffle, for all tables together or, where the rows are counted first, for some keys at a time. Only a key of which some hash was met twice is looked at again, by its
exact values. Relationship checks shuffle distinct keys per task with their counts, so a key that fills a third of the
table travels as one row per task, and a fact with several foreign keys is scanned once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlight.session import path_exists

RESULT_COLUMNS = ["table_name", "check_type", "column_name", "detail", "severity", "failures", "status"]

# Fixed value: what counts as an email address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    detail: str = ""
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    where: str = ""
    severity: str = field(default="error")

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def unique(table: str, column: str) -> Check:
    return Check(table, "unique", (column,))


def not_null(table: str, column: str) -> Check:
    return Check(table, "not_null", (column,))


def accepted_values(table: str, column: str, values: Iterable[str], severity: str = "error") -> Check:
    return Check(table, "accepted_values", (column,), values=tuple(values), severity=severity)


def relationships(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(table, "relationships", (column,), detail=f"{parent}.{parent_column}", parent=parent,
                 parent_column=parent_column)


def expression(table: str, column: str, predicate: str, where: str = "") -> Check:
    """The predicate follows the column name, as in ``mrr`` + ``>= 0``."""
    return Check(table, "expression", (column,), detail=predicate, where=where)


def email(table: str, column: str) -> Check:
    return Check(table, "email", (column,))


def unique_combination(table: str, columns: Iterable[str]) -> Check:
    return Check(table, "unique_combo", tuple(columns))


ROW_KINDS = ("not_null", "accepted_values", "expression", "email")


def row_failure(check: Check) -> Column:
    """True where a row breaks a row-level check."""
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return ~value.isin(list(check.values))
    if check.kind == "email":
        return ~F.regexp_like(value, F.lit(EMAIL_PATTERN))
    failed = ~F.expr(f"{check.columns[0]} {check.detail}")
    return failed & F.expr(check.where) if check.where else failed


def repeated_keys(rows: DataFrame, check: Check) -> DataFrame:
    """Key values that occur more than once, with their number of rows.

    A single column is checked over its non-NULL values; a combination over all rows.
    """
    if check.kind == "unique":
        rows = rows.where(F.col(check.columns[0]).isNotNull())
    return rows.groupBy(*check.columns).agg(F.count("*").alias("n_records")).where("n_records > 1")


def orphan_keys(rows: DataFrame, parents: DataFrame, check: Check) -> DataFrame:
    """Key values without a parent, with their number of rows."""
    column = check.columns[0]
    children = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    parent_keys = parents.select(F.col(check.parent_column).alias(column)).distinct()
    return children.join(parent_keys, column, "left_anti")


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows, or repeated or orphaned keys, that break a check."""
    rows = tables[check.table]
    if check.kind in ROW_KINDS:
        return rows.where(row_failure(check))
    if check.kind == "relationships":
        return orphan_keys(rows, tables[check.parent], check)
    return repeated_keys(rows, check)


def _result(check: Check, failures: Column) -> Column:
    status = F.when(failures == 0, "pass").when(F.lit(check.severity) == "warn", "warn").otherwise("fail")
    values = [
        F.lit(check.table),
        F.lit(check.kind),
        F.lit(check.column_name),
        F.lit(check.detail),
        F.lit(check.severity),
        failures.cast("bigint"),
        status,
    ]
    return F.struct(*[v.alias(name) for v, name in zip(values, RESULT_COLUMNS, strict=True)])


def _masked(checks: list[Check]) -> Column:
    """The row-level checks that a row breaks, as bits; a check that gives NULL is not broken."""
    bits = [F.when(row_failure(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, c in enumerate(checks)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits) if bits else F.lit(0).cast("bigint")


def _key_hash(check: Check) -> Column:
    """The hash of a key, NULL where the key does not count."""
    hashed = F.xxhash64(*check.columns)
    return F.when(F.col(check.columns[0]).isNotNull(), hashed) if check.kind == "unique" else hashed


def _measured(rows: DataFrame, number: int, row_level: list[Check], keys: Mapping[int, Check]) -> DataFrame:
    """``(table, part, value)`` per row: its mask as part -1, if any check is broken, and the hash of each key."""
    mask = F.struct(F.lit(-1).alias("part"), F.nullif(_masked(row_level), F.lit(0).cast("bigint")).alias("value"))
    hashes = [F.struct(F.lit(i).alias("part"), _key_hash(c).alias("value")) for i, c in keys.items()]
    parts = rows.select(F.explode(F.array(*([mask] if row_level else []), *hashes)).alias("m"))
    return parts.select(F.lit(number).alias("table"), "m.part", "m.value").where("value IS NOT NULL")


# Bits of a mask that are used; a table with more row-level checks is scanned once per so many.
MASK_BITS = 62
# Key hashes that a job shuffles, if the rows are counted: keys share a job up to so many, and a key of more rows than
# SLICE_ROWS is taken in slices of its hashes, MOST_SLICES at most.
JOB_ROWS = 16_000_000
SLICE_ROWS = 256_000_000
MOST_SLICES = 8

Group = tuple[str, list[Check], list[Check]]


def _row_counts(tables: Mapping[str, DataFrame], names: list[str]) -> dict[str, int]:
    labels = [tables[name].select(F.lit(name).alias("name")) for name in names]
    return {r["name"]: r["count"] for r in reduce(DataFrame.unionByName, labels).groupBy("name").count().collect()} if labels else {}


def _jobs(tables: Mapping[str, DataFrame], groups: list[Group], counted: bool) -> list[list[DataFrame]]:
    """What each job measures; all in one if the rows are not counted."""
    rows = _row_counts(tables, list(dict.fromkeys(t for t, _, keys in groups if keys))) if counted else {}
    scans = []  # (hashes, what is measured)
    for number, (table, row_level, keys) in enumerate(groups):
        size, known = rows.get(table, 0), dict(enumerate(keys))
        if size * len(keys) <= JOB_ROWS:
            scans.append((size * len(keys), _measured(tables[table], number, row_level, known)))
            continue
        for i, check in known.items():
            slices = min(MOST_SLICES, -(-size // SLICE_ROWS))
            for s in range(slices):
                # The masks ride with the first scan.
                measured = _measured(tables[table], number, row_level if i == s == 0 else [], {i: check})
                if slices > 1:
                    measured = measured.where((F.col("part") == -1) | (F.pmod("value", F.lit(slices)) == s))
                scans.append((-(-size // slices), measured))
    jobs, held = [[]], 0
    for size, measured in scans:
        if jobs[-1] and held + size > JOB_ROWS:
            jobs.append([])
            held = 0
        jobs[-1].append(measured)
        held += size
    return jobs


def _one_pass(tables: Mapping[str, DataFrame], checks: list[Check], counted: bool) -> tuple[dict[Check, int], list[Check]]:
    """Failures of row-level checks, and the keys of which some hash was met twice; one job, or as many as ``counted`` rows ask for."""
    groups: list[Group] = []
    for table in dict.fromkeys(c.table for c in checks):
        row_level = [c for c in checks if c.table == table and c.kind in ROW_KINDS]
        keys = [c for c in checks if c.table == table and c.kind not in ROW_KINDS]
        cuts = range(0, max(len(row_level), 1), MASK_BITS)
        groups += [(table, row_level[i : i + MASK_BITS], keys if i == 0 else []) for i in cuts]
    found = {}
    for measured in _jobs(tables, groups, counted):
        counts = reduce(DataFrame.unionByName, measured).groupBy("table", "part", "value").agg(F.count("*").alias("n"))
        # A mask counts for each of its bits, a hash met twice for its key: one row per check at most.
        bits = F.filter(F.sequence(F.lit(0), F.lit(MASK_BITS - 1)), lambda i: F.getbit("value", i) == 1)
        failed = counts.where("part = -1 OR n > 1").withColumn("bit", F.explode(F.when(F.col("part") == -1, bits).otherwise(F.array(F.lit(-1)))))
        found |= {(r["table"], r["part"], r["bit"]): r["n"] for r in failed.groupBy("table", "part", "bit").agg(F.sum("n").alias("n")).collect()}
    broken, repeated = {}, []
    for number, (_, row_level, keys) in enumerate(groups):
        broken |= {c: found.get((number, -1, bit), 0) for bit, c in enumerate(row_level)}
        repeated += [c for part, c in enumerate(keys) if (number, part, -1) in found]
    return broken, repeated


def _orphan_counts(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Results of relationship checks: every fact and every parent is scanned once.

    Distinct keys with their counts meet the parents' keys; a Bloom filter in their place would let
    some orphans through.
    """
    parents = list(dict.fromkeys((c.parent, c.parent_column) for c in checks))
    children = []
    for table in dict.fromkeys(c.table for c in checks):
        keys = [
            F.struct(F.lit(i).alias("check"), F.lit(parents.index((c.parent, c.parent_column))).alias("parent"), F.col(c.columns[0]).cast("string").alias("key"))
            for i, c in enumerate(checks) if c.table == table
        ]
        children.append(tables[table].select(F.inline(F.array(*keys))).where("key IS NOT NULL"))
    counted = reduce(DataFrame.unionByName, children).groupBy("parent", "key", "check").agg(F.count("*").alias("n"))
    known = [
        tables[name].select(F.lit(i).alias("parent"), F.col(column).cast("string").alias("key")) for i, (name, column) in enumerate(parents)
    ]
    orphans = counted.join(reduce(DataFrame.unionByName, known).distinct(), ["parent", "key"], "left_anti")
    # Grouped first, so the list holds a number per check.
    per_check = orphans.groupBy("check").agg(F.sum("n").alias("n"))
    failures = per_check.agg(F.map_from_entries(F.collect_list(F.struct("check", "n"))).alias("failures"))
    results = [_result(c, F.coalesce(F.try_element_at("failures", F.lit(i)), F.lit(0).cast("bigint"))) for i, c in enumerate(checks)]
    return failures.select(F.inline(F.array(*results)))


def _key_results(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    # A repeated key is one failure.
    counted = failing_rows(check, tables).agg(F.count("*").alias("failures"))
    return counted.select(F.inline(F.array(_result(check, F.col("failures")))))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check], *, counted: bool = False) -> DataFrame:
    """One result row per check: failures, and pass, warn or fail.

    Row-level and uniqueness checks run at once, in one job over all tables; keys with a repeated hash
    are counted exactly and relationships looked up when the result is read. With ``counted`` the rows of tables with keys are counted first, and large
    keys get jobs of their own, so that the disk never holds the hashes of all: for stored tables, where another scan of a key costs little.
    """
    checks = list(checks)
    measured = [c for c in checks if c.kind != "relationships"]
    related = [c for c in checks if c.kind == "relationships"]
    results = []
    if measured:
        broken, repeated = _one_pass(tables, measured, counted)
        known = broken | {c: 0 for c in measured if c.kind not in ROW_KINDS and c not in repeated}
        if known:
            spark = next(iter(tables.values())).sparkSession
            one = spark.range(1).select(F.inline(F.array(*[_result(c, F.lit(n)) for c, n in known.items()])))
            results.append(one)
        results += [_key_results(c, tables) for c in repeated]
    if related:
        results.append(_orphan_counts(tables, related))
    return reduce(DataFrame.unionByName, results)


def failures_path(check: Check, root: str) -> str:
    return f"{root}/{check.table}/{check.kind}__{'__'.join(check.columns)}"


def store_failures(check: Check, tables: Mapping[str, DataFrame], root: str) -> str:
    """Write the failing rows of a check below ``root`` and return the path."""
    path = failures_path(check, root)
    failing_rows(check, tables).write.mode("overwrite").parquet(path)
    return path


FAILED_CHECK = "failed_check"


def store_failing_rows(table: str, tables: Mapping[str, DataFrame], checks: list[Check], root: str) -> DataFrame | None:
    """Write the failing rows of all row-level checks of a table in one scan, whatever fails.

    The rows lie below ``<root>/<table>/rows/failed_check=<kind>__<columns>``, once for each check they break, and take the
    place of an earlier run's. The result reads them back; None if the table has no such check.
    """
    own = [c for c in checks if c.table == table and c.kind in ROW_KINDS]
    if not own:
        return None
    names = F.array_compact(F.array(*[F.when(row_failure(c), F.lit(failures_path(c, "").rsplit("/", 1)[1])) for c in own]))
    rows = tables[table].withColumn(FAILED_CHECK, F.explode(names))
    path = f"{root}/{table}/rows"
    rows.write.mode("overwrite").partitionBy(FAILED_CHECK).parquet(path)
    schema = tables[table].schema.add(FAILED_CHECK, "string")
    return tables[table].sparkSession.read.schema(schema).parquet(path)


def clear_failures(check: Check, spark: SparkSession, root: str) -> None:
    """Leave no rows of an earlier run behind for a check that passes now."""
    path = failures_path(check, root)
    if not path_exists(spark, path):
        return
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


class ChecksFailed(Exception):
    pass


def require(results: DataFrame) -> None:
    """Raise if a check of severity ``error`` failed; one row per check comes to the driver."""
    failed = results.where("status = 'fail'").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.table_name}.{r.column_name} {r.check_type}: {r.failures}" for r in failed))
