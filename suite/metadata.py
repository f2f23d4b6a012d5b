"""Table work: reference data, filters, trees, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorlake.functions import rules
from sensorlake.operators import tables, trees, validation
from sensorlake.plans.base_load import load_base_tables
from sensorlake.session import scratch_path
from sensorlake.sources import sinks
from suite.registry import query

# ---- upsert, ids, lookups ----


@query("upsert_by_key", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus,
       o_custkey FROM orders
UNION ALL SELECT o_orderkey + 100000000, o_totalprice + 1, NULL, o_custkey FROM orders WHERE o_orderkey % 3 = 1""")
def upsert_by_key(t):
    target = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey")
    k = F.col("o_orderkey")
    updates = t.orders.filter(k % 3 != 2).select(
        F.when(k % 3 == 0, k).otherwise(k + 100000000).alias("o_orderkey"), (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_custkey")
    return tables.upsert(target, updates, "o_orderkey")


@query("bulk_insert_defaults", """
SELECT p_partkey, p_name, p_size, p_retailprice FROM part
UNION ALL SELECT p_partkey + 1000000, p_name, 7, p_retailprice FROM part""")
def bulk_insert_defaults(t):
    target = t.part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    rows = t.part.select((F.col("p_partkey") + 1000000).alias("p_partkey"), "p_name", F.lit(None).cast("int").alias("p_size"), "p_retailprice")
    return tables.bulk_insert(target, rows, {"p_size": 7})


@query("assign_sequential_ids", """
SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_id FROM orders""")
def assign_sequential_ids(t):
    return tables.assign_ids(t.orders.select("o_orderdate", "o_orderkey"), "new_id", ["o_orderdate", "o_orderkey"], 1001).select(
        "o_orderkey", "new_id")


@query("upsert_natural_key", """
WITH target AS (SELECT c_custkey AS id, c_name AS code, c_mktsegment AS kind FROM customer WHERE c_nationkey <> 3),
rows AS (SELECT c_name AS code, 'new ' || c_mktsegment AS kind FROM customer),
new AS (SELECT r.*, row_number() OVER (ORDER BY code) + (SELECT max(id) FROM target) AS id FROM rows r
        WHERE code NOT IN (SELECT code FROM target))
SELECT t.id, t.code, r.kind FROM target t JOIN rows r ON t.code = r.code UNION ALL SELECT id, code, kind FROM new""")
def upsert_natural_key(t):
    target = t.customer.filter("c_nationkey <> 3").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("code"),
                                                          F.col("c_mktsegment").alias("kind"))
    rows = t.customer.select(F.col("c_name").alias("code"), F.concat(F.lit("new "), "c_mktsegment").alias("kind"))
    return tables.upsert_natural(target, rows, "id", ["code"], ["code"])


@query("variables_split", """
SELECT p_partkey AS variable_id, p_name || CAST(p_partkey AS VARCHAR) AS variable_term, p_type AS variable_domain_cv,
       CAST(-1.0 * p_size AS DOUBLE) AS min_valid_range, p_retailprice AS max_valid_range FROM part""")
def variables_split(t):
    source = _variables(t)
    variables, ranges = tables.split_variables(source)
    return variables.join(ranges, ["variable_id", "variable_term"])


def _variables(t):
    return t.part.select(F.col("p_partkey").alias("variable_id"), F.concat("p_name", F.col("p_partkey").cast("string")).alias("variable_term"),
                         F.col("p_type").alias("variable_domain_cv"), (-1.0 * F.col("p_size")).alias("min_valid_range"),
                         F.col("p_retailprice").alias("max_valid_range"))


@query("resolve_dim_ids", """
SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey AS manufacturer_id, CASE WHEN l_partkey % 4 <> 0 THEN l_partkey END AS variable_id
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def resolve_dim_ids(t):
    orgs = t.supplier.select(F.col("s_suppkey").alias("organization_id"), F.col("s_name").alias("organization_name"),
                             F.concat(F.lit("code-"), F.col("s_suppkey").cast("string")).alias("organization_code"))
    name = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))).otherwise(
        F.concat(F.lit("code-"), F.col("l_suppkey").cast("string")))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", name.alias("manufacturer"))
    out = tables.resolve_ids(rows, orgs, [("manufacturer", "organization_name"), ("manufacturer", "organization_code")],
                             "organization_id", "manufacturer_id", required=True)
    terms = t.part.filter("p_partkey % 4 <> 0").select("p_partkey", F.col("p_partkey").alias("term"))
    return tables.resolve_ids(out, terms, [("l_partkey", "term")], "p_partkey", "variable_id").drop("manufacturer")


@query("fk_orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 7)")
def fk_orphans(t):
    return tables.find_orphans(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer.filter("c_nationkey <> 7"), "c_custkey")


@query("unique_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_violations(t):
    return tables.find_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


# ---- generic reads and writes ----

@query("meta_exact", "SELECT * EXCLUDE (o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def meta_exact(t):
    return tables.read(t.orders.drop("o_orderdate"), o_orderstatus="F", o_orderpriority="2-HIGH", o_custkey=None)


@query("meta_fuzzy", "SELECT p_partkey, p_name, p_size FROM part WHERE p_name LIKE '%r%d%' AND CAST(p_size AS VARCHAR) LIKE '%1%'")
def meta_fuzzy(t):
    return tables.read_fuzzy(t.part.select("p_partkey", "p_name", "p_size"), p_name="r%d", p_size="1")


_MANY = list(range(0, 3000, 2))


@query("meta_any", f"""
SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderstatus IN ('P', 'X') OR o_custkey IN ({', '.join(map(str, _MANY))})""")
def meta_any(t):
    return tables.read_any(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), o_orderstatus=["P", "X"], o_custkey=_MANY)


@query("meta_by_id", "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey = 42")
def meta_by_id(t):
    return tables.read(tables.columns(t.customer, ["c_custkey", "c_name", "c_nationkey"]), c_custkey=42)


@query("meta_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 256 OFFSET 512")
def meta_page(t):
    return tables.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 256, 512)


@query("meta_count", "SELECT count(*) AS row_count FROM lineitem WHERE l_returnflag = 'R'")
def meta_count(t):
    return tables.count(t.lineitem, l_returnflag="R")


@query("meta_cols", "SELECT l_orderkey, l_shipmode FROM (SELECT l_orderkey, l_linestatus AS l_shipmode FROM lineitem)")
def meta_cols(t):
    return tables.columns(t.lineitem.withColumnRenamed("l_linestatus", "l_shipmode"), ["l_orderkey", "l_shipmode"])


@query("meta_distinct", "SELECT DISTINCT o_custkey FROM orders")
def meta_distinct(t):
    return tables.distinct(t.orders, "o_custkey")


@query("meta_insert", """
SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey + 1000000000, s_name, NULL FROM supplier""")
def meta_insert(t):
    new = t.supplier.select((F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"))
    return tables.insert(t.customer.select("c_custkey", "c_name", "c_acctbal"), new)


@query("meta_update", """
SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'moved ' || c_name ELSE c_name END AS c_name,
       CASE WHEN c_nationkey < 5 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, c_nationkey FROM customer""")
def meta_update(t):
    base = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    updates = base.filter("c_nationkey < 10").select(
        "c_custkey", F.concat(F.lit("moved "), "c_name").alias("c_name"), F.when(F.col("c_nationkey") < 5, F.col("c_acctbal") * 2).alias("c_acctbal"))
    return tables.update_rows(base, updates, "c_custkey")


@query("meta_delete", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')")
def meta_delete(t):
    return tables.delete_rows(t.orders, o_orderstatus="P", o_orderpriority="1-URGENT").select("o_orderkey", "o_orderstatus")


@query("meta_follow_fk", "SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def meta_follow_fk(t):
    with_customer = tables.follow(t.orders, "o_custkey", t.customer, "c_custkey")
    return tables.follow(with_customer, "c_nationkey", t.nation, "n_nationkey").select("o_orderkey", "c_name", "n_name")


@query("out_json_rows", """
SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '","segment":'
       || CASE WHEN c_nationkey = 1 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS json,
       '[' || CAST(c_custkey AS VARCHAR) || ',"' || c_name || '",' || CASE WHEN c_nationkey = 1 THEN 'null' ELSE '"' || c_mktsegment || '"' END || ']' AS list
FROM customer""")
def out_json_rows(t):
    rows = t.customer.select("c_custkey", "c_name", F.when(F.col("c_nationkey") != 1, F.col("c_mktsegment")).alias("segment"))
    key = F.get_json_object("json", "$.c_custkey")
    objects = sinks.json_rows(rows).withColumn("k", key)
    lists = sinks.json_arrays(rows).select(F.col("json").alias("list"), F.get_json_object("json", "$[0]").alias("k"))
    return objects.join(lists, "k").select("json", "list")


# ---- trees ----

def _as_files(t, documents):
    """Write one document per line, as the sites come in, and read the files back. The files are compressed: as plain text they are many times
    the tables they are made of."""
    path = scratch_path(t.spark, "documents")
    documents.write.option("compression", "gzip").text(path)
    return t.spark.read.text(path).withColumnRenamed("value", "body")


def site_documents(t):
    """One nested document per order: the order, its line items, one port below each line item."""
    def line(r):
        text = lambda c: r[c].cast("string")
        code = F.concat_ws("-", F.lit("L"), text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"))
        port = F.struct(F.concat(code, F.lit("-port")).alias("sampling_feature_code"),
                        F.concat(F.lit("uuid-"), code, F.lit("-port")).alias("sampling_feature_uuid"), F.lit(1.5).alias("elevation_m"),
                        F.lit("isChildOf").alias("relation_to_parent"))
        return F.struct(
            code.alias("sampling_feature_code"), F.concat(F.lit("uuid-"), code).alias("sampling_feature_uuid"),
            r["l_quantity"].alias("elevation_m"), F.lit("isChildOf").alias("relation_to_parent"),
            F.array(F.struct(r["l_returnflag"].alias("alias"), F.lit("flag").alias("alias_category"))).alias("sampling_feature_alias"),
            F.array(F.struct(F.lit("status").alias("property_name"), r["l_linestatus"].alias("property_value"))).alias("extension_properties"),
            F.array(port).alias("child_sampling_features"))

    raw = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus")
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(raw).alias("rows"))
    root = F.concat(F.lit("O-"), F.col("l_orderkey").cast("string"))
    return grouped.select(F.to_json(F.struct(
        root.alias("sampling_feature_code"), F.concat(F.lit("uuid-"), root).alias("sampling_feature_uuid"), F.lit(10.0).alias("elevation_m"),
        F.transform("rows", line).alias("child_sampling_features"))).alias("body"))


_LINE_CODE = "'L-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)"


@query("tree_flatten", f"""
WITH l AS (SELECT *, {_LINE_CODE} AS code FROM lineitem)
SELECT 'node' AS part, code AS sampling_feature_code, CAST(l_quantity AS VARCHAR) AS detail, '1' AS depth FROM l
UNION ALL SELECT 'node', code || '-port', '1.5', '2' FROM l
UNION ALL SELECT 'node', 'O-' || CAST(l_orderkey AS VARCHAR), '10.0', '0' FROM l GROUP BY l_orderkey
UNION ALL SELECT 'edge', code, 'isChildOf', 'O-' || CAST(l_orderkey AS VARCHAR) FROM l
UNION ALL SELECT 'edge', code || '-port', 'isChildOf', code FROM l
UNION ALL SELECT 'alias', code, l_returnflag, 'flag' FROM l
UNION ALL SELECT 'property', code, 'status', l_linestatus FROM l""")
def tree_flatten(t):
    out = trees.flatten_feature_tree(_as_files(t, site_documents(t)), "body", max_depth=4)
    part = lambda name, df, a, b: df.select(
        F.lit(name).alias("part"), "sampling_feature_code", F.col(a).cast("string").alias("detail"), F.col(b).cast("string").alias("depth"))
    return (part("node", out["nodes"], "elevation_m", "depth")
            .unionByName(part("edge", out["edges"], "relationship_type_cv", "related_feature_code"))
            .unionByName(part("alias", out["aliases"], "alias", "alias_category"))
            .unionByName(part("property", out["properties"], "property_name", "property_value")))


@query("tree_deep", """
WITH d AS (SELECT c_custkey, k, 30 + c_custkey % 11 AS levels FROM customer, generate_series(0, 40) g(k) WHERE k < 30 + c_custkey % 11)
SELECT 'node' AS part, 'C-' || c_custkey || '-' || k AS sampling_feature_code, CAST(k AS VARCHAR) AS detail, CASE WHEN k > 0 THEN 'C-' || c_custkey || '-' || (k - 1) END AS parent FROM d
UNION ALL SELECT 'related', 'C-' || c_custkey || '-' || k, CAST(c_custkey AS VARCHAR), 'wasCollectedAt' FROM d WHERE k = levels - 1""")
def tree_deep(t):
    """A chain of features per customer, 30 to 40 levels deep; the lowest one names a feature outside of its tree."""
    key = F.col("c_custkey").cast("string")
    levels = F.expr("30 + c_custkey % 11").cast("int")

    def around(inner, k):
        code = F.concat(F.lit("C-"), key, F.lit("-"), k.cast("string"))
        related = F.concat(F.lit('"related_features":[{"relation_to_related_feature":"wasCollectedAt","related_feature_id":'), key, F.lit("}],"))
        return F.concat(F.lit('{"sampling_feature_code":"'), code, F.lit('","sampling_feature_uuid":"u-'), code, F.lit('","relation_to_parent":"isChildOf",'),
                        F.when(inner == "", related).otherwise(""), F.lit('"child_sampling_features":['), inner, F.lit("]}"))

    docs = t.customer.select(F.aggregate(F.reverse(F.sequence(F.lit(0), levels - 1)), F.lit(""), around).alias("body"))
    out = trees.flatten_feature_tree(docs, "body")
    parents = out["edges"].select("sampling_feature_code", F.col("related_feature_code").alias("parent"))
    nodes = out["nodes"].select("sampling_feature_code", F.col("depth").cast("string").alias("detail")).join(parents, "sampling_feature_code", "left")
    related = out["related"].select(F.lit("related").alias("part"), "sampling_feature_code", F.col("related_feature_id").cast("string").alias("detail"),
                                    F.col("relationship_type_cv").alias("parent"))
    return nodes.select(F.lit("node").alias("part"), "sampling_feature_code", "detail", "parent").unionByName(related)


@query("tree_duplicate_check", """
SELECT 'sampling_feature_code' AS field, code AS value, count(*) AS n, count(DISTINCT (u, q)) > 1 AS differs
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS code, CAST(l_partkey AS VARCHAR) AS u, l_quantity AS q FROM lineitem)
GROUP BY code HAVING count(*) > 1
UNION ALL
SELECT 'sampling_feature_uuid', u, count(*), count(DISTINCT (code, q)) > 1
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS code, CAST(l_partkey AS VARCHAR) AS u, l_quantity AS q FROM lineitem)
GROUP BY u HAVING count(*) > 1""")
def tree_duplicate_check(t):
    nodes = t.lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sampling_feature_code"),
        F.col("l_partkey").cast("string").alias("sampling_feature_uuid"), F.col("l_quantity").alias("elevation_m"))
    return trees.check_feature_tree(nodes)


def equipment_documents(t):
    """One equipment document per order: a logger with one sensor per line item."""
    def sensor(r):
        text = lambda c: r[c].cast("string")
        return F.struct(
            F.concat_ws("-", F.lit("s"), text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey")).alias("equipment_uuid"),
            F.concat(F.lit("part-"), text("l_partkey")).alias("equipment_code"), F.lit("sensor").alias("equipment_name"),
            F.when(r["l_tax"] > 0.02, F.concat(F.lit("org-"), text("l_suppkey"))).alias("equipment_vendor"),
            F.lit("Ada").alias("equipment_owner_first_name"), F.lit("Byron").alias("equipment_owner_last_name"),
            r["l_suppkey"].alias("position_start_date_utc"), r["l_suppkey"].alias("relationship_start_date_time_utc"),
            (-r["l_quantity"] / 10).alias("equipment_z_offset_m"))

    raw = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax")
    grouped = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(raw).alias("rows"))
    return grouped.select(F.to_json(F.struct(
        F.concat(F.lit("o-"), F.col("l_orderkey").cast("string")).alias("equipment_uuid"), F.lit("part-0").alias("equipment_code"),
        F.lit("logger").alias("equipment_name"), F.lit("nobody").alias("equipment_vendor"), F.lit("Ada").alias("equipment_owner_first_name"),
        F.lit("Byron").alias("equipment_owner_last_name"), F.lit(5).alias("position_start_date_utc"), F.lit(2.0).alias("equipment_z_offset_m"),
        F.transform("rows", sensor).alias("equipment"))).alias("body"))


@query("equipment_flatten", """
WITH s AS (SELECT 's-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS u,
                  * FROM lineitem)
SELECT u AS equipment_uuid, l_partkey + 1 AS model_id, CASE WHEN l_tax > 0.02 THEN l_suppkey ELSE -1 END AS vendor_id, CAST(11 AS BIGINT) AS owner_id,
       'o-' || CAST(l_orderkey AS VARCHAR) AS parent FROM s
UNION ALL SELECT 'o-' || CAST(l_orderkey AS VARCHAR), 1, -1, 11, NULL FROM s GROUP BY l_orderkey""")
def equipment_flatten(t):
    models = t.part.select((F.col("p_partkey") + 1).alias("equipment_model_id"),
                           F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("equipment_model_part_number"))
    orgs = t.supplier.select(F.col("s_suppkey").alias("organization_id"), F.concat(F.lit("org-"), F.col("s_suppkey").cast("string")).alias("organization_code"))
    orgs = orgs.unionByName(t.spark.sql("SELECT -1L AS organization_id, 'unknown' AS organization_code"))
    persons = t.spark.sql("SELECT 11L AS person_id, 'Ada' AS person_first_name, 'Byron' AS person_last_name")
    out = trees.flatten_equipment_tree(_as_files(t, equipment_documents(t)), "body", models, orgs, persons, max_depth=3)
    return out["attached"].select(
        "equipment_uuid", F.col("equipment_model_id").alias("model_id"), F.col("equipment_vendor_id").alias("vendor_id"),
        F.col("equipment_owner_id").alias("owner_id"), F.col("parent_uuid").alias("parent"))


@query("nest_tree", """
WITH o AS (SELECT o_custkey, 'o' || CAST(o_orderkey AS VARCHAR) AS code, o_orderstatus AS kind FROM orders),
od AS (SELECT o_custkey, code, '{"code":"' || code || '","kind":"' || kind || '","child_sampling_features":[]}' AS doc FROM o),
og AS (SELECT o_custkey, count(*) AS n, string_agg(doc, ',' ORDER BY code) AS docs FROM od GROUP BY 1),
cd AS (SELECT c_nationkey, 'c' || CAST(c_custkey AS VARCHAR) AS code, coalesce(n, 0) + 1 AS n,
         '{"code":"c' || CAST(c_custkey AS VARCHAR) || '","kind":"' || c_mktsegment || '","child_sampling_features":[' || coalesce(docs, '') || ']}' AS doc
       FROM customer LEFT JOIN og ON o_custkey = c_custkey),
cg AS (SELECT c_nationkey, sum(n) AS n, string_agg(doc, ',' ORDER BY code) AS docs FROM cd GROUP BY 1),
nd AS (SELECT n_regionkey, 'n' || CAST(n_nationkey AS VARCHAR) AS code, coalesce(n, 0) + 1 AS n,
         '{"code":"n' || CAST(n_nationkey AS VARCHAR) || '","kind":"' || n_name || '","child_sampling_features":[' || coalesce(docs, '') || ']}' AS doc
       FROM nation LEFT JOIN cg ON c_nationkey = n_nationkey),
ng AS (SELECT n_regionkey, sum(n) AS n, string_agg(doc, ',' ORDER BY code) AS docs FROM nd GROUP BY 1)
SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS code, CAST(coalesce(n, 0) + 1 AS BIGINT) AS node_count,
       '{"code":"r' || CAST(r_regionkey AS VARCHAR) || '","kind":"' || r_name || '","child_sampling_features":[' || coalesce(docs, '') || ']}' AS document
FROM region LEFT JOIN ng ON n_regionkey = r_regionkey""")
def nest_tree(t):
    def level(df, letter, key, parent_letter, parent_key, kind):
        parent = F.concat(F.lit(parent_letter), F.col(parent_key).cast("string")) if parent_key else F.lit(None).cast("string")
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("code"), parent.alias("parent"), F.col(kind).alias("kind"))

    nodes = (level(t.region, "r", "r_regionkey", "", None, "r_name")
             .unionByName(level(t.nation, "n", "n_nationkey", "r", "n_regionkey", "n_name"))
             .unionByName(level(t.customer, "c", "c_custkey", "n", "c_nationkey", "c_mktsegment"))
             .unionByName(level(t.orders, "o", "o_orderkey", "c", "o_custkey", "o_orderstatus")))
    return trees.nest_tree(nodes, "code", "parent").select("code", "node_count", "document")


@query("nest_attachments", """
WITH cd AS (SELECT c_nationkey, 'c' || c_custkey AS code,
    '{"code":"c' || c_custkey || '","kind":"' || c_mktsegment || '","aliases":[{"alias":"A' || c_custkey || '","display_priority":1}'
      || CASE WHEN c_custkey % 2 = 0 THEN ',{"alias":"B' || c_custkey || '","display_priority":null}' ELSE '' END
      || '],"related_features":[' || CASE WHEN c_custkey % 3 = 0 THEN '{"relationship_type_cv":"isNear","related_feature_id":' || c_nationkey || '}' ELSE '' END
      || '],"child_sampling_features":[]}' AS doc FROM customer),
cg AS (SELECT c_nationkey, count(*) AS n, string_agg(doc, ',' ORDER BY code) AS docs FROM cd GROUP BY 1)
SELECT 'n' || n_nationkey AS code, CAST(coalesce(n, 0) + 1 AS BIGINT) AS node_count,
  '{"code":"n' || n_nationkey || '","kind":"' || n_name || '","aliases":[],"related_features":[],"child_sampling_features":[' || coalesce(docs, '') || ']}' AS document
FROM nation LEFT JOIN cg ON c_nationkey = n_nationkey""")
def nest_attachments(t):
    """Customers below nations, with their aliases and related features in the documents."""
    text = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    nodes = t.nation.select(text("n", "n_nationkey").alias("code"), F.lit(None).cast("string").alias("parent"), F.col("n_name").alias("kind")).unionByName(
        t.customer.select(text("c", "c_custkey").alias("code"), text("n", "c_nationkey").alias("parent"), F.col("c_mktsegment").alias("kind")))
    code = text("c", "c_custkey").alias("code")
    aliases = t.customer.select(code, text("A", "c_custkey").alias("alias"), F.lit(1).alias("display_priority")).unionByName(
        t.customer.filter("c_custkey % 2 = 0").select(code, text("B", "c_custkey").alias("alias"), F.lit(None).cast("int").alias("display_priority")))
    related = t.customer.filter("c_custkey % 3 = 0").select(code, F.lit("isNear").alias("relationship_type_cv"), F.col("c_nationkey").alias("related_feature_id"))
    return trees.nest_tree(nodes, "code", "parent", attachments={"aliases": aliases, "related_features": related}).select("code", "node_count", "document")


@query("tree_duplicate_fields", """
WITH n AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS code, CAST(l_partkey AS VARCHAR) AS u, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, l_returnflag AS k FROM lineitem),
long AS (
  SELECT 'sampling_feature_code' AS field, code AS value, f AS differs, CASE f WHEN 'sampling_feature_uuid' THEN u WHEN 'elevation_m' THEN q ELSE k END AS shown
  FROM n, (VALUES ('sampling_feature_uuid'), ('elevation_m'), ('kind')) v(f)
  UNION ALL SELECT 'sampling_feature_uuid', u, f, CASE f WHEN 'sampling_feature_code' THEN code WHEN 'elevation_m' THEN q ELSE k END
  FROM n, (VALUES ('sampling_feature_code'), ('elevation_m'), ('kind')) v(f)),
held AS (SELECT field, value, differs, shown, count(*) AS n FROM long GROUP BY ALL)
SELECT field, value, differs, shown, n FROM held QUALIFY count(*) OVER (PARTITION BY field, value, differs) > 1""")
def tree_duplicate_fields(t):
    nodes = t.lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("sampling_feature_code"),
        F.col("l_partkey").cast("string").alias("sampling_feature_uuid"), F.col("l_quantity").cast("bigint").alias("elevation_m"), F.col("l_returnflag").alias("kind"))
    return trees.duplicate_fields(nodes)


# ---- validation ----

RECORD_SCHEMA = {
    "type": "array",
    "items": {
        "type": "object", "additionalProperties": False, "required": ["column_name", "size", "expose"],
        "properties": {
            "column_name": {"type": "string", "minLength": 9},
            "size": {"type": "integer"},
            "offset": {"type": ["number", "null"], "minimum": 0},
            "expose": {"type": "boolean"},
            "kind": {"type": "string", "enum": ["ECONOMY", "SMALL"]},
        },
    },
}


@query("schema_violations", """
WITH r AS (SELECT p_partkey, p_name, p_type, p_size, p_partkey % 6 AS k FROM part),
v AS (
  SELECT p_partkey, 'json' AS violation FROM r WHERE k = 5
  UNION ALL SELECT p_partkey, 'column_name: minLength' FROM r WHERE k <> 5 AND length(p_name) < 9
  UNION ALL SELECT p_partkey, 'size: type' FROM r WHERE k = 1
  UNION ALL SELECT p_partkey, 'size: required' FROM r WHERE k = 2
  UNION ALL SELECT p_partkey, 'offset: minimum' FROM r WHERE k NOT IN (3, 5) AND p_size < 10
  UNION ALL SELECT p_partkey, 'kind: enum' FROM r WHERE k <> 5 AND p_type NOT IN ('ECONOMY', 'SMALL')
  UNION ALL SELECT p_partkey, 'additional property' FROM r WHERE k = 4)
SELECT p_partkey, violation FROM v""")
def schema_violations(t):
    k, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    body = F.concat(
        F.lit('{"column_name":"'), "p_name", F.lit('","expose":true,"kind":"'), "p_type", F.lit('","offset":'),
        F.when(k == 3, "null").otherwise((F.col("p_size") - 10 + 0.5).cast("string")),
        F.when(k == 1, F.concat(F.lit(',"size":"'), size, F.lit('"'))).when(k == 2, F.lit("")).otherwise(F.concat(F.lit(',"size":'), size)),
        F.when(k == 4, ',"extra":1').otherwise(""), F.when(k == 5, "").otherwise("}"))
    _, bad = validation.validate_records(t.part.select("p_partkey", body.alias("body")), "body", RECORD_SCHEMA)
    return bad.select("p_partkey", "violation")


NESTED_SCHEMA = {
    "type": "array",
    "items": {
        "type": "object", "required": ["column_name", "ranges"], "additionalProperties": False,
        "properties": {
            "column_name": {"type": "string"},
            "ranges": {"type": ["array", "null"], "minItems": 1, "items": {"$ref": "#/definitions/range"}},
        },
    },
    "definitions": {"range": {
        "type": "object", "required": ["datetime_start", "datetime_end", "qa_flag"],
        "properties": {"datetime_start": {"type": ["string", "null"], "format": "date-time"}, "datetime_end": {"type": ["string", "null"], "format": "date-time"},
                       "qa_flag": {"type": "string", "enum": ["b", "w"]}},
    }},
}
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag"


@query("schema_nested", f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS i FROM lineitem),
v AS (
  SELECT l_orderkey, 'ranges[' || i || '].qa_flag: required' AS violation FROM l WHERE l_linenumber % 4 = 0
  UNION ALL SELECT l_orderkey, 'ranges[' || i || '].qa_flag: enum' FROM l WHERE l_linenumber % 4 <> 0 AND l_returnflag = 'R'
  UNION ALL SELECT l_orderkey, 'ranges[' || i || '].datetime_start: type' FROM l WHERE l_quantity > 45
  UNION ALL SELECT l_orderkey, 'ranges[' || i || '].datetime_end: format' FROM l WHERE l_partkey % 3 = 0)
SELECT l_orderkey, violation FROM v WHERE l_orderkey % 7 <> 0
UNION ALL SELECT DISTINCT l_orderkey, 'json' FROM l WHERE l_orderkey % 7 = 0""")
def schema_nested(t):
    """Column records with a list of ranges each, as one text per order."""
    day = F.when(F.col("l_partkey") % 3 == 0, '"2024-01-32T00:00:00Z"').otherwise('"2024-01-31T00:00:00Z"')
    text = F.concat(F.lit('{"datetime_start":'), F.when(F.col("l_quantity") > 45, "7").otherwise("null"), F.lit(',"datetime_end":'), day,
                    F.when(F.col("l_linenumber") % 4 != 0, F.concat(F.lit(',"qa_flag":"'), F.when(F.col("l_returnflag") == "R", "R").otherwise("b"), F.lit('"'))).otherwise(""),
                    F.lit("}"))
    items = F.array_sort(F.collect_list(F.struct(*_LINE_ORDER.split(", "), text.alias("text"))))
    records = t.lineitem.groupBy("l_orderkey").agg(items.alias("items")).select(
        "l_orderkey", F.concat(F.lit('{"column_name":"c","ranges":['), F.array_join(F.transform("items", lambda x: x["text"]), ","),
                               F.when(F.col("l_orderkey") % 7 == 0, "").otherwise("]}")).alias("body"))
    _, bad = validation.validate_records(records, "body", NESTED_SCHEMA, formats=True)
    return bad.select("l_orderkey", "violation")


TREE_SCHEMA = {
    "type": "array",
    "items": {
        "type": "object", "required": ["code", "size"],
        "properties": {"code": {"type": "string"}, "size": {"type": "number", "minimum": 0}, "equipment": {"type": ["array", "null"], "items": {"$ref": "#/items"}}},
    },
}


@query("schema_recursive", f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS i FROM lineitem)
SELECT l_orderkey, 'equipment[' || i || '].code: required' AS violation FROM l WHERE l_linenumber % 5 = 0
UNION ALL SELECT l_orderkey, 'equipment[' || i || '].equipment[0].size: type' FROM l WHERE l_quantity > 40
UNION ALL SELECT l_orderkey, 'equipment[' || i || '].equipment[0].equipment[0].size: minimum' FROM l WHERE l_partkey % 4 = 0""")
def schema_recursive(t):
    """Equipment with equipment in it, four levels deep, against a schema that refers to itself."""
    deepest = F.concat(F.lit('{"code":"x","size":'), F.when(F.col("l_partkey") % 4 == 0, "-1").otherwise("1"), F.lit("}"))
    port = F.concat(F.lit('{"code":"p","size":'), F.when(F.col("l_quantity") > 40, '"big"').otherwise("2.5"), F.lit(',"equipment":['), deepest, F.lit("]}"))
    line = F.concat(F.lit("{"), F.when(F.col("l_linenumber") % 5 != 0, '"code":"l",').otherwise(""), F.lit('"size":1,"equipment":['), port, F.lit("]}"))
    items = F.array_sort(F.collect_list(F.struct(*_LINE_ORDER.split(", "), line.alias("text"))))
    records = t.lineitem.groupBy("l_orderkey").agg(items.alias("items")).select("l_orderkey", F.concat(
        F.lit('{"code":"o","size":0,"equipment":['), F.array_join(F.transform("items", lambda x: x["text"]), ","), F.lit("]}")).alias("body"))
    _, bad = validation.validate_records(records, "body", TREE_SCHEMA)
    return bad.select("l_orderkey", "violation")


@query("rule_violations", """
WITH r AS (SELECT event_id, user_id, value, event_type, ts, event_id % 8 AS k FROM events)
SELECT event_id,
  concat_ws(',', CASE WHEN k = 1 THEN 'count:integer' WHEN k <> 2 AND user_id > 100 THEN 'count:integer' END,
    CASE WHEN value > 200 THEN 'reading:float' END, CASE WHEN k = 3 THEN 'flag:bool' END,
    CASE WHEN event_type IN ('view', 'signup') THEN 'kind:enum' END, CASE WHEN k IN (4, 5) THEN 'ids:id_list' END,
    CASE WHEN k = 6 THEN 'day:datetime' END, CASE WHEN k = 7 THEN 'span:datetime_range' END,
    CASE WHEN length(event_type) > 6 THEN 'name:length' END, CASE WHEN user_id = 0 THEN 'listen:port' END,
    CASE WHEN k = 0 THEN 'extra:json' END) AS found FROM r""")
def rule_violations(t):
    k, c = F.col("event_id") % 8, lambda n: F.col(n).cast("string")
    records = t.events.select(
        "event_id", F.when(k == 1, "true").when(k == 2, "3.0").otherwise(c("user_id")).alias("count"), c("value").alias("reading"),
        F.when(k == 3, "yes").when(k == 4, "TRUE").otherwise("0").alias("flag"), F.initcap("event_type").alias("kind"),
        F.when(k == 4, "[1, 0]").when(k == 5, "7x").when(k == 6, "12").otherwise(
            F.concat(F.lit("[1, "), (F.col("event_id") + 1).cast("string"), F.lit("]"))).alias("ids"),
        F.when(k == 6, "2024-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.when(k == 7, "2024-02-01").otherwise("2024-01-01").alias("first"), F.lit("1704153600").alias("last"), F.col("event_type").alias("name"),
        c("user_id").alias("listen"), F.when(k == 0, "{bad").otherwise(F.col("props")).alias("extra"))
    found = rules.violations(
        count=rules.integer(F.col("count"), upper=100), reading=rules.floating(F.col("reading"), upper=200.0), flag=rules.boolean(F.col("flag")),
        kind=rules.one_of(F.col("kind"), ["CLICK", "error", "Purchase"]), ids=rules.id_list(F.col("ids")),
        day=rules.date_time(F.col("day"), lower=0), span=rules.date_range(F.col("first"), F.col("last")),
        name=rules.text_length(F.col("name"), upper=6), listen=rules.port(F.col("listen")), extra=rules.json_text(F.col("extra")))
    return records.select("event_id", F.array_join(found, ",").alias("found"))


@query("base_load_orphans", """
SELECT 'equipment_models' AS child, 'equipment_model_manufacturer_id' AS fk, 0::BIGINT AS orphans, (SELECT count(*) FROM part) AS row_count
UNION ALL SELECT 'affiliations', 'organization_id', 0, (SELECT count(*) FROM customer)
UNION ALL SELECT 'affiliations', 'person_id', 0, (SELECT count(*) FROM customer)""")
def base_load_orphans(t):
    text = lambda c: F.col(c).cast("string")
    incoming = {
        "organizations": t.supplier.select(F.col("s_name").alias("organization_name"), F.concat(F.lit("org-"), text("s_suppkey")).alias("organization_code")),
        "persons": t.customer.select(F.col("c_name").alias("person_name")),
        "affiliations": t.customer.select(F.col("c_name").alias("person_name"), F.concat(F.lit("org-"), F.pmod("c_custkey", F.lit(10)).cast("string")).alias("organization_code")),
        "equipment_models": t.part.select(F.concat(F.lit("part-"), text("p_partkey")).alias("equipment_model_part_number"),
                                          F.concat(F.lit("org-"), F.pmod("p_partkey", F.lit(10)).cast("string")).alias("equipment_manufacturer_name")),
    }
    loaded, report = load_base_tables({}, incoming)
    return report
