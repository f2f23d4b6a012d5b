"""Loading the base tables in the order of their references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.operators.tables import assign_ids, find_orphans, resolve_ids, upsert_natural

# Load order: table, id column, unique columns (a tuple is unique as a whole), and which columns are looked up as (columns, table, dim columns, as).
LOAD_ORDER = (
    ("organizations", "organization_id", ("organization_code",), ()),
    ("persons", "person_id", ("person_name",), ()),
    ("affiliations", "affiliation_id", (("person_id", "organization_id"),), (
        ("person_name", "persons", ("person_name",), "person_id"),
        ("organization_code", "organizations", ("organization_code",), "organization_id"))),
    ("equipment_models", "equipment_model_id", ("equipment_model_part_number",), (
        ("equipment_manufacturer_name", "organizations", ("organization_name", "organization_code"), "equipment_model_manufacturer_id"),)),
    ("features_of_interest", "features_of_interest_id", ("features_of_interest_name",), ()),
    ("extension_properties", "property_id", ("property_name",), ()),
    ("methods", "method_id", ("method_code",), ()),
)


def load_base_tables(stored: dict[str, DataFrame], incoming: dict[str, DataFrame],
                     update_only: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """New versions of the base tables and a reference report ``child, fk, orphans, row_count``.

    Each table is upserted by its natural key after the tables it refers to, with names replaced by ids; a name
    that resolves to nothing is an error. The report counts rows whose reference is missing after the load.
    """
    loaded, ids, report = dict(stored), {name: id_col for name, id_col, _, _ in LOAD_ORDER}, None
    for name, id_col, unique, lookups in LOAD_ORDER:
        if name not in incoming:
            continue
        rows = incoming[name]
        for column, dim, dim_columns, as_col in lookups:
            rows = resolve_ids(rows, loaded[dim], [(column, d) for d in dim_columns], ids[dim], as_col, required=True).drop(column)
        order = [c for u in unique for c in (u if isinstance(u, tuple) else (u,))]
        if name in loaded:
            loaded[name] = upsert_natural(loaded[name], rows, id_col, list(unique), order, update_only)
        elif update_only:
            raise ValueError(f"{name} would be new, which update-only mode forbids")
        else:
            loaded[name] = assign_ids(rows, id_col, order)
        for _, dim, _, as_col in lookups:
            orphans = find_orphans(loaded[name], as_col, loaded[dim].withColumnRenamed(ids[dim], "_dim_id"), "_dim_id")
            line = orphans.agg(F.count("*").alias("orphans")).select(F.lit(name).alias("child"), F.lit(as_col).alias("fk"), "orphans")
            line = line.withColumn("row_count", loaded[name].agg(F.count("*")).scalar())
            report = line if report is None else report.unionByName(line)
    return loaded, report
