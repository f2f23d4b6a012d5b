"""Consistency, freshness, comparison and synchronisation of stores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.operators.process import good_summary
from sensorlake.operators.tables import upsert
from sensorlake.session import small_side

DAY = 86400


def check_registry(registry: DataFrame, observations: DataFrame) -> DataFrame:
    """Registry rows that disagree with the data: stored and actual first time, last time and good count."""
    actual = good_summary(observations)
    joined = registry.join(actual, "datastream_id", "full").withColumn("good_count", F.coalesce("good_count", F.lit(0)))
    same = (F.col("first_measurement_date").eqNullSafe(F.col("first_good"))
            & F.col("last_measurement_date").eqNullSafe(F.col("last_good"))
            & F.coalesce("total_measurement_numbers", F.lit(0)).eqNullSafe(F.col("good_count")))
    return joined.filter(~same).select(
        "datastream_id", "first_measurement_date", "first_good", "last_measurement_date", "last_good",
        "total_measurement_numbers", "good_count")


def fix_registry(registry: DataFrame, problems: DataFrame) -> DataFrame:
    """Registry with the wrong rows set to what the data says."""
    fixes = problems.select("datastream_id", F.col("first_good").alias("first_measurement_date"),
                            F.col("last_good").alias("last_measurement_date"),
                            F.col("good_count").alias("total_measurement_numbers"))
    return upsert(registry, fixes, "datastream_id")


def empty_streams(observations: DataFrame, streams: DataFrame, ranges: DataFrame, at_least: int = 10) -> DataFrame:
    """Streams with ``at_least`` readings and no good one, with variable, units and valid range."""
    none = good_summary(observations).filter((F.col("good_count") == 0) & (F.col("row_count") >= at_least))
    return (none.select("datastream_id", "row_count").join(streams, "datastream_id", "left")
            .join(ranges, "variable_term", "left"))


def last_n(observations: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` non-null readings per stream. The rank limit is applied before and after the shuffle, so a
    dominant stream sends only ``n`` rows per task."""
    newest = W.partitionBy("datastream_id").orderBy(F.desc("utc_time"), F.desc("data_value"), F.desc("qa_flag"))
    return (observations.filter("data_value IS NOT NULL").withColumn("rank", F.row_number().over(newest))
            .filter(F.col("rank") <= n))


def rename_by_fragments(name: Column, renames: dict[str, str]) -> Column:
    """Replace the first fragment (in the order of the table) that occurs in the name."""
    out = name
    for old, new in reversed(list(renames.items())):
        out = F.when(F.contains(name, F.lit(old)), F.replace(name, F.lit(old), F.lit(new))).otherwise(out)
    return out


def with_terms(df: DataFrame, terms: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Ids replaced by what they stand for: ``terms`` gives for a column the table, its id and its term column. An id that the table does not
    have becomes ``unknown <id>``, NULL stays."""
    for name, (table, id_col, term) in terms.items():
        known = table.groupBy(F.col(id_col).alias("_id")).agg(F.min(F.col(term).cast("string")).alias("_term"))
        joined = df.join(known, F.col(name) == F.col("_id"), "left")
        df = joined.withColumn(name, F.coalesce("_term", F.concat(F.lit("unknown "), F.col(name).cast("string")))).drop("_id", "_term")
    return df


def registry_differences(old: DataFrame, new: DataFrame, renames: dict[str, str], fields: list[str], old_terms: dict[str, tuple[DataFrame, str, str]],
                         new_terms: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """One row per stream and field that differs: ``datastream_tablename, field, old, new``. Each store numbers its variables, units and
    features itself, so ids are replaced by their terms on both sides before they are compared. A stream that the new store lacks
    has one row with the field ``datastream_tablename``."""
    found = diff_registry(with_terms(old, old_terms), with_terms(new, new_terms), renames, fields)
    missing = F.array(F.struct(F.lit("datastream_tablename").alias("field"), F.col("datastream_tablename").alias("old"), F.lit(None).cast("string").alias("new")))
    rows = F.when(F.col("status") == "missing", missing).otherwise(F.col("differences"))
    return found.select("datastream_tablename", F.explode(rows).alias("d")).select("datastream_tablename", "d.field", "d.old", "d.new")


def diff_registry(old: DataFrame, new: DataFrame, renames: dict[str, str], fields: list[str]) -> DataFrame:
    """Old streams against new ones by (renamed) table name: ``status`` is ``missing``, ``different`` or ``same``,
    ``differences`` lists field, old and new value."""
    left = old.select(F.col("datastream_tablename").alias("name_old"), rename_by_fragments(
        F.col("datastream_tablename"), renames).alias("name"), *[F.col(f).alias(f"_old_{f}") for f in fields])
    right = new.select(F.col("datastream_tablename").alias("name"), F.lit(True).alias("_there"),
                       *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = left.join(right, "name", "left")
    unequal = [F.when(~F.col(f"_old_{f}").eqNullSafe(F.col(f"_new_{f}")), F.struct(
        F.lit(f).alias("field"), F.col(f"_old_{f}").cast("string").alias("old"), F.col(f"_new_{f}").cast("string").alias("new")))
        for f in fields]
    differences = F.when(F.col("_there"), F.array_compact(F.array(*unequal)))
    status = F.when(F.col("_there").isNull(), "missing").when(F.size(differences) > 0, "different").otherwise("same")
    return joined.select(F.col("name_old").alias("datastream_tablename"), status.alias("status"), differences.alias("differences"))


def diff_data_fast(old: DataFrame, new: DataFrame) -> DataFrame:
    """Per stream: row counts in both stores and whether the contents are equal (order-free hash)."""
    def digest(df: DataFrame, tag: str) -> DataFrame:
        row = F.xxhash64("utc_time", "data_value", "qa_flag")
        return df.groupBy("datastream_id").agg(
            F.count("*").alias(f"{tag}_rows"), F.bit_xor(row).alias(f"_{tag}_xor"),
            F.sum(F.pmod(row, F.lit(2_147_483_647))).alias(f"_{tag}_sum"))

    joined = digest(old, "old").join(digest(new, "new"), "datastream_id", "full")
    equal = reduce(lambda a, b: a & b, [F.col(f"{a}old{b}").eqNullSafe(F.col(f"{a}new{b}")) for a, b in
                                        (("", "_rows"), ("_", "_xor"), ("_", "_sum"))])
    return joined.select("datastream_id", F.coalesce("old_rows", F.lit(0)).alias("old_rows"),
                         F.coalesce("new_rows", F.lit(0)).alias("new_rows"), equal.alias("equal"))


def diff_data_deep(old: DataFrame, new: DataFrame) -> DataFrame:
    """Readings that differ, rows with NULL or NaN values left out: ``change`` is ``removed``, ``added`` or ``changed``."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.filter("data_value IS NOT NULL AND NOT isnan(data_value) AND qa_flag IS NOT NULL").select(
            "datastream_id", "utc_time", F.col("data_value").alias(f"{tag}_value"), F.col("qa_flag").alias(f"{tag}_flag"))

    joined = side(old, "old").join(side(new, "new"), ["datastream_id", "utc_time"], "full")
    same = F.col("old_value").eqNullSafe(F.col("new_value")) & F.col("old_flag").eqNullSafe(F.col("new_flag"))
    change = F.when(F.col("new_flag").isNull(), "removed").when(F.col("old_flag").isNull(), "added").otherwise("changed")
    return joined.filter(~same).withColumn("change", change)


def freshness(local: DataFrame, remote: DataFrame, now: int) -> DataFrame:
    """Class of every local stream: how its count and last time compare to the remote store and to ``now``."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select("datastream_tablename", F.col("last_measurement_date").alias(f"{tag}_last"),
                         F.col("total_measurement_numbers").alias(f"{tag}_n"), F.lit(True).alias(f"{tag}_there"))

    joined = side(local, "local").join(side(remote, "remote"), "datastream_tablename", "left")
    behind, age = F.col("remote_last") - F.col("local_last"), F.lit(now) - F.col("local_last")
    status = (F.when(F.col("remote_there").isNull(), "remote missing")
              .when((F.col("local_n") < F.col("remote_n")) & (behind > DAY), "behind more than 24 hours")
              .when(F.col("local_n") < F.col("remote_n"), "behind within 24 hours")
              .when((F.col("local_n") == F.col("remote_n")) & (age > DAY), "up to date, data older than 24 hours")
              .when(F.col("local_n") == F.col("remote_n"), "up to date")
              .otherwise("remote has fewer"))
    return joined.select("datastream_tablename", "local_n", "remote_n", status.alias("status"))


def sync_delta(local_registry: DataFrame, remote_registry: DataFrame, remote_observations: DataFrame,
               by: str = "datastream_uuid", min_flag: str = "a") -> dict[str, DataFrame]:
    """What a local store has to take from a remote one: ``report``, ``rows`` and ``registry``.

    Streams match by uuid or table name. When the counts differ, remote readings in ``(local last, remote last]``
    (from the remote's first time on, that one included, when nothing is stored) with a flag from ``min_flag`` on are taken under the
    local id, and the registry takes the remote's last time and count.
    """
    if by not in ("datastream_uuid", "datastream_tablename"):
        raise ValueError("streams match by datastream_uuid or datastream_tablename")
    remote = remote_registry.select(
        F.col(by).alias("_by"), F.col("datastream_id").alias("remote_id"), F.col("first_measurement_date").alias("remote_first"),
        F.col("last_measurement_date").alias("remote_last"), F.coalesce("total_measurement_numbers", F.lit(0)).alias("remote_n"))
    matched = remote.join(local_registry.withColumn("_by", F.col(by)), "_by", "left")
    local_n = F.coalesce("total_measurement_numbers", F.lit(0))
    action = (F.when(F.col("datastream_id").isNull(), "not found locally")
              .when(local_n == F.col("remote_n"), "equal")
              .when(local_n > F.col("remote_n"), "local has more")
              .when(F.col("remote_last").isNull(), "remote is empty")
              .otherwise("update"))
    plan = matched.withColumn("action", action).withColumns({
        "_start": F.coalesce("last_measurement_date", F.col("remote_first") - 1)})
    todo = small_side(plan.filter("action = 'update'").select("remote_id", F.col("datastream_id").alias("local_id"), "_start", "remote_last"))
    rows = (remote_observations.filter(F.col("qa_flag") >= min_flag)
            .join(todo, F.col("datastream_id") == F.col("remote_id"))
            .filter((F.col("utc_time") > F.col("_start")) & (F.col("utc_time") <= F.col("remote_last")))
            .select(F.col("local_id").alias("datastream_id"), "utc_time", "data_value", "qa_flag"))
    moved = plan.filter("action = 'update'").select(
        "datastream_id", F.col("remote_last").alias("last_measurement_date"), F.col("remote_n").alias("total_measurement_numbers"))
    return {
        "report": plan.select(F.col("_by").alias(by), "datastream_id", "remote_id", local_n.alias("local_n"), "remote_n", "action"),
        "rows": rows,
        "registry": upsert(local_registry, moved, "datastream_id"),
    }


def variables_with_ranges(variables: DataFrame, ranges: DataFrame) -> DataFrame:
    """Variables with their valid range, if any."""
    return variables.join(ranges.select("variable_id", "min_valid_range", "max_valid_range"), "variable_id", "left")


def source_entries(devices: DataFrame, existing: DataFrame, source: str, project: str, auth: str) -> DataFrame:
    """Configuration records (JSON) of devices that have none yet: ``device_name, entry``.

    ``devices``: ``id, location, model``; ``existing``: ``device_name``.
    """
    name = F.concat_ws("_", "location", "model")
    new = devices.withColumn("device_name", name).join(existing.select("device_name"), "device_name", "left_anti")
    entry = F.struct(
        F.struct(F.lit(source).alias("data_source_name"), F.lit("project_specific").alias("data_source_scope"),
                 F.lit("UTC").alias("data_source_timezone"),
                 F.concat(F.lit(f"{project}/{source}/"), "device_name").alias("data_source_path")).alias("shared_info"),
        F.struct(F.lit(auth).alias("auth_yml"), F.col("id").alias("device_id"), "device_name").alias("harvesting_info"),
        F.struct(F.lower("device_name").alias("feeder_table")).alias("ingestion_info"),
        F.struct(F.col("location").alias("sampling_feature_code"),
                 F.concat(F.lit(f"{source}/"), "device_name").alias("equipment_directory")).alias("processing_info"))
    return new.select("device_name", F.to_json(entry).alias("entry"))
