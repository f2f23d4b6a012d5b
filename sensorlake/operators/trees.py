"""Site and equipment trees: flatten nested documents, climb adjacency lists, nest them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.operators.tables import resolve_ids
from sensorlake.schemas import split_fields
from sensorlake.session import durable, written


def ancestor_sums(nodes: DataFrame) -> DataFrame:
    """``id, total, cyclic`` from ``id, parent_id, weight``: the weight of a node and all its ancestors.

    Every round joins the table with itself and doubles the distance a row has climbed, so a tree of depth d
    needs log2(d) joins. No path is longer than there are rows, so a row that has climbed further and still climbs sits on or
    below a cycle. A row that has arrived carries a NULL target and leaves the join.
    """
    climbed = 1
    current = durable(nodes.select("id", F.col("weight").alias("total"), F.col("parent_id").alias("at")))
    longest = current.count()
    while climbed <= longest and not current.filter("at IS NOT NULL").isEmpty():
        above = current.select(F.col("id").alias("at"), F.col("total").alias("more"), F.col("at").alias("further"))
        moving = current.filter("at IS NOT NULL").join(above, "at", "left").select(
            "id", (F.col("total") + F.coalesce("more", F.lit(0))).alias("total"), F.col("further").alias("at"))
        current = durable(current.filter("at IS NULL").unionByName(moving))
        climbed *= 2
    cyclic = F.col("at").isNotNull()
    return current.select("id", F.when(~cyclic, F.col("total")).alias("total"), cyclic.alias("cyclic"))


#: Levels of a document that are parsed in one go.
LEVELS = 4


def _document_type(fields: str, children: str, depth: int) -> str:
    """JSON schema of a node with ``depth`` levels below it; deeper children stay raw text."""
    below = "string" if depth == 0 else f"array<{_document_type(fields, children, depth - 1)}>"
    return f"struct<{fields},{children}:{below}>"


def _explode_levels(frontier: DataFrame, fields: str, children: str, key: str, levels: int) -> DataFrame:
    """Rows of the first levels of raw nodes (``depth, parent_key, raw``: an array as text), the lowest with their raw children in ``_rest``.
    The levels are unrolled inside the row with array functions, so there is no shuffle."""
    names = [part.split(":", 1)[0] for part in split_fields(fields)]
    kind = f"array<{_document_type(fields, children, levels - 1)}>"
    row = frontier.select("depth", "parent_key", F.from_json("raw", kind, {"mode": "FAILFAST"}).alias("nodes"))
    row = row.selectExpr("depth", "transform(nodes, n -> named_struct('parent_key', parent_key, 'node', n)) AS level0")
    for depth in range(1, levels):
        row = row.selectExpr("*", f"""flatten(filter(transform(level{depth - 1}, p -> transform(p.node.`{children}`,
            c -> named_struct('parent_key', p.node.`{key}`, 'node', c))), x -> x IS NOT NULL)) AS level{depth}""")

    def shaped(depth: int) -> str:
        rest = f"nullif(p.node.`{children}`, '[]')" if depth == levels - 1 else "CAST(NULL AS STRING)"
        own = "".join(f"'{n}', p.node.`{n}`, " for n in names)
        return f"transform(level{depth}, p -> named_struct('depth', depth + {depth}, 'parent_key', p.parent_key, {own}'_rest', {rest}))"

    return row.selectExpr(f"explode(concat({', '.join(map(shaped, range(levels)))})) AS n").select("n.*")


def explode_documents(docs: DataFrame, body: str, fields: str, children: str, key: str, max_depth: int | None = None, levels: int = LEVELS) -> DataFrame:
    """Nested JSON documents of any depth to one row per node: ``depth, parent_key`` and the node's ``fields``.

    Documents are parsed ``levels`` deep; what lies below stays text, and is what the next round parses, until nothing is left. Each round
    is written, so a node is parsed by one round only. With ``max_depth`` a deeper document is an error, never cut.
    """
    frontier = docs.select(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent_key"), F.concat(F.lit("["), body, F.lit("]")).alias("raw"))
    done, parsed = None, 0
    while done is None or not frontier.isEmpty():
        if max_depth is not None and parsed > max_depth:
            raise ValueError(f"tree deeper than {max_depth} levels")
        step = levels if max_depth is None else min(levels, max_depth + 1 - parsed)
        rows = written(_explode_levels(frontier, fields, children, key, step), "nodes")
        done = rows.drop("_rest") if done is None else done.unionByName(rows.drop("_rest"))
        frontier = rows.filter("_rest IS NOT NULL").select((F.col("depth") + 1).alias("depth"), F.col(key).alias("parent_key"), F.col("_rest").alias("raw"))
        parsed += step
    return done


FEATURE_FIELDS = (
    "sampling_feature_uuid:string,sampling_feature_type_cv:string,sampling_feature_code:string,sampling_feature_name:string,"
    "sampling_feature_description:string,sampling_feature_geotype_cv:string,feature_geometry_wkt:string,elevation_m:double,"
    "elevation_datum_cv:string,epsg:int,latitude:double,longitude:double,"
    "relation_to_parent:string,sampling_feature_alias:array<struct<alias:string,alias_category:string,display_priority:int>>,"
    "extension_properties:array<struct<property_name:string,property_value:string>>,"
    "related_features:array<struct<relation_to_related_feature:string,related_feature_id:bigint>>")


def flatten_feature_tree(docs: DataFrame, body: str, max_depth: int | None = None) -> dict[str, DataFrame]:
    """Site documents to ``nodes``, ``edges``, ``related``, ``aliases`` and ``properties``; ids are hashes of the uuid.

    The documents are parsed once, into tables that the outputs read. A child without ``relation_to_parent`` is an error. ``related`` are the
    relations to other features that a document names by id, whether they are in its tree or not.
    """
    rows = explode_documents(docs, body, FEATURE_FIELDS, "child_sampling_features", "sampling_feature_code", max_depth)
    nodes = rows.drop("parent_key", "sampling_feature_alias", "extension_properties", "related_features").withColumn(
        "sampling_feature_id", F.xxhash64("sampling_feature_uuid"))
    missing = F.raise_error(F.concat(F.lit("no relation_to_parent for "), F.col("sampling_feature_code"))).cast("string")
    edges = rows.filter("parent_key IS NOT NULL").select(
        "sampling_feature_code", F.coalesce("relation_to_parent", missing).alias("relationship_type_cv"),
        F.col("parent_key").alias("related_feature_code"))
    related = rows.select("sampling_feature_code", F.explode("related_features").alias("r")).select(
        "sampling_feature_code", F.col("r.relation_to_related_feature").alias("relationship_type_cv"), "r.related_feature_id").distinct()
    aliases = rows.select("sampling_feature_code", F.explode("sampling_feature_alias").alias("a")).select("sampling_feature_code", "a.*")
    properties = rows.select("sampling_feature_code", F.explode("extension_properties").alias("p")).select("sampling_feature_code", "p.*")
    return {"nodes": nodes, "edges": edges, "related": related, "aliases": aliases, "properties": properties}


def check_feature_tree(nodes: DataFrame) -> DataFrame:
    """Codes or uuids used more than once, and how many different records share them."""
    rest = [c for c in nodes.columns if c not in ("sampling_feature_code", "sampling_feature_uuid", "depth")]

    def repeated(name: str) -> DataFrame:
        other = "sampling_feature_uuid" if name == "sampling_feature_code" else "sampling_feature_code"
        record = F.xxhash64(F.to_json(F.struct(other, *rest)))
        return (nodes.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"), F.min(record).alias("a"), F.max(record).alias("b"))
                .filter("n > 1").select(F.lit(name).alias("field"), "value", "n", (F.col("a") != F.col("b")).alias("differs")))

    return repeated("sampling_feature_code").unionByName(repeated("sampling_feature_uuid"))


#: Repeated keys are told apart by so many buckets. A bucket of over ``HOT`` rows and ten times the average is not dealt out by key.
KEY_BUCKETS, HOT = 1 << 16, 50_000


def duplicate_fields(nodes: DataFrame) -> DataFrame:
    """In what the records of a repeated code or uuid differ: ``field, value`` (what is repeated), ``differs`` (the other field), ``shown`` (what
    it holds there, as text) and ``n`` (in how many records).

    Records are dealt out by key once and taken apart into fields where they have arrived, so a record travels as one narrow row. A key with very
    many records is not gathered in one place: rows are counted by bucket of the key first, and in buckets far above the average
    what the records hold is counted before it is compared.
    """
    keys = ("sampling_feature_code", "sampling_feature_uuid")
    bucket = {name: F.pmod(F.xxhash64(name), F.lit(KEY_BUCKETS)).cast("int") for name in keys}
    sides = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.when(F.col(name).isNotNull(), b).alias("bucket")) for name, b in bucket.items()]))
    counted = nodes.select(sides.alias("k")).select("k.*").filter("bucket IS NOT NULL").groupBy("field", "bucket").agg(F.count("*").alias("n"))
    average = F.avg("n").over(Window.partitionBy("field"))
    hot = counted.withColumn("average", average).filter((F.col("n") > HOT) & (F.col("n") > 10 * F.col("average"))).select("field", "bucket").collect()

    def repeated(name: str) -> DataFrame:
        rest = [c for c in nodes.columns if c not in (name, "depth", "sampling_feature_id")]
        texts = {c: F.col(c).cast("string") if kind in ("string", "int", "bigint", "double", "boolean", "date", "timestamp", "timestamp_ntz") else F.to_json(c)
                 for c, kind in nodes.dtypes if c in rest}

        def held(records: DataFrame) -> DataFrame:
            # Not an unpivot: that would forget that the records lie by key.
            fields = F.explode(F.array(*[F.struct(F.lit(c).alias("differs"), t.alias("shown")) for c, t in texts.items()]))
            long = records.select(F.col(name).alias("value"), fields.alias("f")).select("value", "f.*")
            return long.groupBy("value", "differs", "shown").agg(F.count("*").alias("n"))

        def named(found: DataFrame) -> DataFrame:
            return found.select(F.lit(name).alias("field"), "value", "differs", "shown", "n")

        records = nodes.select(name, *rest).filter(F.col(name).isNotNull())
        many = [r["bucket"] for r in hot if r["field"] == name]
        here = held((records.filter(~bucket[name].isin(many)) if many else records).repartition(name))
        kinds = F.count("*").over(Window.partitionBy("value", "differs"))
        found = named(here.withColumn("_kinds", kinds).filter("_kinds > 1"))
        if not many:
            return found
        spread = held(records.filter(bucket[name].isin(many)))
        several = spread.groupBy("value", "differs").agg(F.count("*").alias("_kinds")).filter("_kinds > 1").drop("_kinds")
        return found.unionByName(named(spread.join(several, ["value", "differs"])))

    return repeated(keys[0]).unionByName(repeated(keys[1]))


EQUIPMENT_FIELDS = (
    "equipment_uuid:string,equipment_code:string,equipment_name:string,equipment_serial_number:string,equipment_vendor:string,"
    "equipment_description:string,equipment_owner_first_name:string,equipment_owner_last_name:string,equipment_owner_role:string,"
    "equipment_purchase_date:string,equipment_purchase_order_number:string,equipment_documentation_link:string,"
    "position_start_date_utc:bigint,position_end_date_utc:bigint,"
    "relationship_start_date_time_utc:bigint,relationship_end_date_time_utc:bigint,equipment_z_offset_m:double,"
    "equipment_ns_offset_m:double,equipment_ew_offset_m:double,equipment_height_note:string")


def flatten_equipment_tree(docs: DataFrame, body: str, models: DataFrame, organizations: DataFrame, persons: DataFrame,
                           max_depth: int | None = None) -> dict[str, DataFrame]:
    """Equipment documents to ``equipment``, ``positions``, ``owners`` and ``edges``, and ``attached``: the equipment, each row with the
    ``parent_uuid`` of the document it stands in, so nobody has to join the outputs for it.

    The model is found by part number (an error when absent), the vendor by code with ``unknown`` as fallback, the
    owner by name (an error when a name is given that is not known). Positions are keyed by equipment and start, owners by equipment and
    person; children are attached to their parent. Vendors and owners are looked up first, and broadcast if they are few.
    """
    rows = explode_documents(docs, body, EQUIPMENT_FIELDS, "equipment", "equipment_uuid", max_depth)
    ided = rows.withColumns({"equipment_id": F.xxhash64("equipment_uuid"), "parent_id": F.when(
        F.col("parent_key").isNotNull(), F.xxhash64("parent_key"))})
    # One id for all rows without a known vendor: looked up once, not joined.
    unknown = organizations.filter(F.col("organization_code") == "unknown").agg(F.min("organization_id").alias("organization_id")).scalar()
    names = persons.withColumn("_name", F.concat_ws(" ", "person_first_name", "person_last_name"))
    equipment = rows.withColumn("_owner", F.concat_ws(" ", "equipment_owner_first_name", "equipment_owner_last_name"))
    equipment = resolve_ids(equipment, organizations, [("equipment_vendor", "organization_code")], "organization_id", "_vendor_id", count_first=True)
    equipment = resolve_ids(equipment, names, [("_owner", "_name")], "person_id", "equipment_owner_id", count_first=True)
    stranger = (F.col("_owner") != "") & F.col("equipment_owner_id").isNull()
    equipment = equipment.withColumns({
        "equipment_vendor_id": F.coalesce(F.col("_vendor_id"), unknown),
        "equipment_owner_id": F.when(stranger, F.raise_error(F.concat(F.lit("no person_id for "), F.col("_owner"))).cast("bigint")).otherwise(
            F.col("equipment_owner_id"))})
    equipment = resolve_ids(equipment, models, [("equipment_code", "equipment_model_part_number")], "equipment_model_id",
                            "equipment_model_id", required=True)
    # The id is made of the uuid after the shuffle, which need not carry both.
    equipment = equipment.withColumn("equipment_id", F.xxhash64("equipment_uuid"))
    attached = equipment.select(
        "equipment_id", "equipment_uuid", "equipment_code", "equipment_name", "equipment_serial_number", "equipment_description", "equipment_model_id",
        "equipment_vendor_id", "equipment_owner_id", "equipment_purchase_date", "equipment_purchase_order_number", "equipment_documentation_link",
        F.col("parent_key").alias("parent_uuid"))
    return {
        "equipment": attached.drop("parent_uuid"),
        "attached": attached,
        "positions": ided.select("equipment_id", "position_start_date_utc", "position_end_date_utc",
                                 F.coalesce("equipment_z_offset_m", F.lit(0.0)).alias("equipment_z_offset_m"), "equipment_ns_offset_m",
                                 "equipment_ew_offset_m", "equipment_height_note").distinct(),
        "owners": equipment.filter("equipment_owner_id IS NOT NULL").select(
            "equipment_id", F.col("equipment_owner_id").alias("person_id"), F.col("equipment_owner_role").alias("person_role_cv")).distinct(),
        "edges": ided.filter("parent_id IS NOT NULL").select(
            "equipment_id", F.lit("isAttachedTo").alias("relationship_type_cv"), F.col("parent_id").alias("related_equipment_id"),
            "relationship_start_date_time_utc", "relationship_end_date_time_utc"),
    }


def gather_attachments(attachments: dict[str, DataFrame], code: str) -> DataFrame:
    """Several child tables by node in one pass: ``code`` and one sorted array per table, empty where a node has none. All tables go through one
    aggregate, so each node meets its rows once."""
    together = None
    for name, rows in attachments.items():
        own = rows.select(code, F.struct(*[c for c in rows.columns if c != code]).alias(name))
        together = own if together is None else together.unionByName(own, allowMissingColumns=True)
    return together.groupBy(code).agg(*[F.array_sort(F.collect_list(name)).alias(name) for name in attachments])


def nest_tree(nodes: DataFrame, code: str, parent: str, cut: int = 1, children: str = "child_sampling_features",
              attachments: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adjacency list to nested JSON documents: ``code, parent, node_count, document``. ``attachments`` are child tables (such as aliases,
    properties, related features) that have the node's ``code``; their rows become a list of that name in the node's document.

    Levels are folded from the leaves up, one aggregate each, and each is written once. ``cut`` is the level (roots are 1) whose
    subtrees become documents; nodes above it are documents without children, and every document names its parent. The
    shape depends on this choice alone, never on sizes: one document is one row, so trees too large for a row are
    cut further down by the caller. Cycles are an error.
    """
    if attachments:
        gathered = gather_attachments(attachments, code)
        nodes = nodes.join(gathered, code, "left").withColumns({n: F.coalesce(n, F.array().cast(gathered.schema[n].dataType)) for n in attachments})
    fields = [c for c in nodes.columns if c not in (code, parent)]
    depths = ancestor_sums(nodes.select(F.col(code).alias("id"), F.col(parent).alias("parent_id"), F.lit(1).alias("weight")))
    worst = depths.agg(F.max("total").alias("depth"), F.max("cyclic").alias("cyclic")).first()
    if worst["cyclic"]:
        raise ValueError("the tree has a cycle")
    leveled = durable(nodes.join(depths.select(F.col("id").alias(code), F.col("total").alias("_level")), code))
    head = F.to_json(F.struct(code, *fields), {"ignoreNullFields": "false"})
    own = F.left("_head", F.length("_head") - 1)

    def document(kids: Column) -> Column:
        return F.concat(own, F.lit(f',"{children}":['), F.coalesce(kids, F.lit("")), F.lit("]}"))

    standalone, below = None, None
    for level in range(worst["depth"] or 0, 0, -1):
        here = leveled.filter(F.col("_level") == level).select(code, parent, head.alias("_head"))
        if below is None:
            folded = here.select(code, parent, F.lit(1).cast("bigint").alias("node_count"), document(F.lit("")).alias("document"))
        else:
            if level < cut:
                standalone = below if standalone is None else standalone.unionByName(below)
                below = below.limit(0)
            kids = below.groupBy(F.col(parent).alias("_p")).agg(
                F.array_sort(F.collect_list(F.struct(code, "document"))).alias("_kids"), F.sum("node_count").alias("_size"))
            text = F.array_join(F.transform("_kids", lambda k: k["document"]), ",")
            folded = here.join(kids, F.col(code) == F.col("_p"), "left").select(
                code, parent, (F.coalesce("_size", F.lit(0)) + 1).alias("node_count"), document(text).alias("document"))
        below = written(folded, "level")
    if below is None:
        return leveled.select(code, parent, F.lit(0).cast("bigint").alias("node_count"), F.lit("").alias("document")).limit(0)
    return below if standalone is None else below.unionByName(standalone)
