"""Records whose schema drifts between files: one typed table, a rescue column, and a report of each change."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelane.plans.joins import join_null_safe, small_side
from tidelane.plans.lineage import cut

#: JSON type of the values that a SQL type holds as they are.
OWN_TYPE = {"string": "string", "boolean": "boolean", "tinyint": "number", "smallint": "number", "int": "number", "bigint": "number", "float": "number", "double": "number"}
SCALARS = ("string", "number", "boolean")


def json_type(text: Column) -> Column:
    """JSON type of a JSON value's text by its first sign; NULL for a JSON null, which tells nothing."""
    sign = F.substring(text, 1, 1)
    return F.when(sign == '"', "string").when(sign == "{", "object").when(sign == "[", "array").when(sign.isin("t", "f"), "boolean").when(sign != "n", "number")


def parse_record(payload: Column) -> Column:
    """The top-level fields of a JSON text as MAP<STRING, VARIANT>; NULL unless it is one intact object.

    Damaged or truncated text, other JSON values, empty text, text after the object and an
    object that names a field twice are no record.
    """
    whole = F.trim(payload).startswith("{") & F.trim(payload).endswith("}")
    return F.when(whole, F.try_parse_json(payload)).try_cast("map<string,variant>")


def _typed(fields: Column, name: str, kind: str) -> Column:
    """The value of a field as SQL type ``kind``; NULL if absent, not a scalar or not castable."""
    value = F.try_element_at(fields, F.lit(name))
    return F.when(json_type(F.to_json(value)).isin(*SCALARS), F.try_variant_get(value, "$", kind))


def ingest(df: DataFrame, payload: str, keys: list[str], target: dict[str, str], *, strict: bool = False) -> DataFrame:
    """Rescue-column ingestion of JSON lines into the ``target`` schema {field: SQL type}.

    Returns ``keys``, one column ``t_<field>`` per target field, ``rescued`` (a JSON object text with each
    non-null field that is not in the target, isn't a scalar or doesn't cast to its type; NULL if none) and
    ``fields`` (MAP<STRING, STRUCT<kind, value>>: JSON type and JSON text of each field of the record).
    ``strict``: a value whose JSON type isn't that of its column isn't cast but rescued, and so are nulls, so
    that typed columns and ``rescued`` together tell which fields a record has, and of which type.

    No value is lost: each non-null field is in its typed column or in ``rescued``.  Lines that are no intact
    record (see :func:`parse_record`) are left out; :func:`damaged` gives those.  Nulls in any column, empty
    and very long texts, copies and an empty table are fine; other columns are not read.
    """
    rows = df.select(*keys, parse_record(F.col(payload)).alias("_m")).where(F.col("_m").isNotNull())
    rows = rows.select(*keys, "_m", F.transform_values("_m", lambda _, v: F.to_json(v)).alias("_t"))
    held = {f: json_type(F.try_element_at("_t", F.lit(f))) for f in target}
    fit = {f: held[f] == OWN_TYPE.get(kind.lower(), "") if strict else held[f].isin(*SCALARS) for f, kind in target.items()}
    rows = rows.select(*keys, "_m", "_t", *(F.when(fit[f], F.try_variant_get(F.try_element_at("_m", F.lit(f)), "$", kind)).alias(f"t_{f}") for f, kind in target.items()))
    told = (lambda t: t.isNotNull()) if strict else (lambda t: json_type(t).isNotNull())
    pair = lambda k, t: F.concat(_quoted(k), F.lit(":"), t)
    # From texts, not from values: a JSON text stands as it is in the object's text.  Fields of the target are looked at one by one.
    unknown = F.map_entries(F.map_filter("_t", lambda k, t: ~k.isin(list(target)) & told(t))) if target else F.map_entries(F.map_filter("_t", lambda k, t: told(t)))
    unfit = [F.when(F.col(f"t_{f}").isNull() & told(F.try_element_at("_t", F.lit(f))), pair(F.lit(f), F.try_element_at("_t", F.lit(f)))) for f in target]
    rest = F.concat(F.array_compact(F.array(F.lit(None).cast("string"), *unfit)), F.transform(unknown, lambda e: pair(e["key"], e["value"])))
    rows = rows.select(*keys, "_t", *(f"t_{f}" for f in target), F.array_join(rest, ",").alias("_rest"))
    return rows.select(
        *keys,
        *(f"t_{f}" for f in target),
        F.when(F.col("_rest") != "", F.concat(F.lit("{"), "_rest", F.lit("}"))).alias("rescued"),
        F.transform_values("_t", lambda _, t: F.struct(json_type(t).alias("kind"), t.alias("value"))).alias("fields"),
    )


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(r'[\\"\x00-\x1f]'), F.regexp_extract(F.to_json(F.struct(text.alias("k"))), r"(?s)^\{\"k\":(.*)\}$", 1)).otherwise(plain)


def held_fields(ingested: DataFrame, keys: list[str], target: dict[str, str], *, values: bool, only: Column | None = None) -> DataFrame:
    """(keys, ``name``, ``kind``) of each field of each strictly ingested record, from its typed columns and its rescued fields.

    ``kind`` is the JSON type, NULL for a null.  With ``values`` also ``value``, a text that is equal for equal values
    of a kind (numbers as doubles).  Of records that don't fulfil ``only`` nothing is given.
    """
    def entry(name: Column, kind: Column, value: Column) -> Column:
        return F.struct(name.alias("name"), kind.alias("kind"), *([value.alias("value")] if values else []))

    def same(column: Column, kind: str) -> Column:
        return (column.cast("double") if kind == "number" else column).cast("string")

    rest = F.try_parse_json("rescued").try_cast("map<string,variant>")
    rows = ingested.withColumn("_r", F.map_entries(F.transform_values(rest, lambda _, v: F.struct(F.to_json(v).alias("t"), *([F.try_variant_get(v, "$", "string").alias("s")] if values else [])))))
    typed = [F.when(F.col(f"t_{f}").isNotNull(), entry(F.lit(f), F.lit(OWN_TYPE[kind.lower()]), same(F.col(f"t_{f}"), OWN_TYPE[kind.lower()]))) for f, kind in target.items() if kind.lower() in OWN_TYPE]

    def rescued(e: Column) -> Column:
        kind = json_type(e["value"]["t"])
        text = e["value"]["t"]
        return entry(e["key"], kind, F.when(kind == "number", text.try_cast("double").cast("string")).when(kind == "string", e["value"]["s"]).otherwise(text) if values else text)

    all_ = F.concat(F.array_compact(F.array(*typed)), F.coalesce(F.transform("_r", rescued), F.array()))
    return rows.select(*keys, F.explode(all_ if only is None else F.when(only, all_)).alias("x")).select(*keys, "x.*")


def damaged(df: DataFrame, payload: str) -> DataFrame:
    """The rows of ``df`` whose payload is no intact record (null payloads too)."""
    return df.where(parse_record(F.col(payload)).isNull())


def promote(ingested: DataFrame, field: str, kind: str) -> DataFrame:
    """Give an approved field its own typed column and replay its rescued values into it.

    ``t_<field>`` gets the rescued values that are scalars and cast to ``kind`` (a column that exists keeps
    the values it has); those leave ``rescued``, others stay there.
    """
    rest = F.try_parse_json("rescued").try_cast("map<string,variant>")
    rows = ingested.withColumn("_m", rest)
    value = _typed(F.col("_m"), field, kind)
    name = f"t_{field}"
    had = F.col(name).cast(kind) if name in ingested.columns else F.lit(None).cast(kind)
    left = F.map_filter("_m", lambda k, _: k != F.lit(field))
    rescued = F.when(value.isNull() | had.isNotNull(), F.col("rescued")).when(F.cardinality(left) > 0, F.to_json(left))
    return rows.withColumns({name: F.coalesce(had, value), "rescued": rescued}).drop("_m")


def schema_changes(df: DataFrame, payload: str, target: dict[str, str], *, feed: str, file_no: str, pair_keys: list[str]) -> DataFrame:
    """Each change of the top-level fields of a file against the previous present file of its feed.

    Args: ``df`` has the lines of all files (a file is present if it has any line) with ``feed``, ``file_no`` and ``payload``;
    ``target`` is the schema that they are ingested into (see :func:`ingest`); ``pair_keys`` are fields of it.

    Returns ``feed``, ``file_no``, ``change_kind`` ('added', 'removed', 'renamed', 'retyped'), ``field``,
    ``new_field`` (equal to ``field`` unless renamed).

    A file has a field if any of its records does.  A gone field is renamed to a new one if records of both
    files with equal ``pair_keys`` (none null or of another type) hold non-null values under both names and all of these are
    equal.  If several fit, the pair with most records, then the first names, and each field once.
    Retyped: the sets of JSON types (nulls aside) differ and neither is empty.

    Defined cases: the first file of a feed changes nothing; a present file without records has no
    fields; null feeds and file numbers are left out; an empty table gives no row.

    Lines are ingested strictly, and the fields are those of the typed columns and of the rescue column.  Names and types are
    reduced per file before the shuffle.  Values are read only of the files in which a field went and another came, reduced to
    one smallest and largest value per record key first.
    """
    lines = df.select(F.col(feed).alias("feed"), F.col(file_no).alias("no"), F.col(payload).alias("line")).where(F.col("feed").isNotNull() & F.col("no").isNotNull())
    present = lines.select("feed", "no").distinct()
    steps = present.withColumn("prev", F.lag("no").over(Window.partitionBy("feed").orderBy("no"))).where(F.col("prev").isNotNull())
    fields = held_fields(ingest(lines, "line", ["feed", "no"], target, strict=True), ["feed", "no"], target, values=False)
    has = cut(fields.distinct().groupBy("feed", "no", "name").agg(F.sort_array(F.collect_list("kind")).alias("kinds")))
    now = steps.join(has, ["feed", "no"]).select("feed", "no", "prev", "name", F.col("kinds").alias("new_kinds"), F.lit(None).cast("array<string>").alias("old_kinds"))
    was = steps.join(has.withColumnRenamed("no", "prev"), ["feed", "prev"]).select("feed", "no", "prev", "name", F.lit(None).cast("array<string>").alias("new_kinds"), F.col("kinds").alias("old_kinds"))
    both = now.unionByName(was).groupBy("feed", "no", "prev", "name").agg(F.max("new_kinds").alias("new_kinds"), F.max("old_kinds").alias("old_kinds"))
    gone, came = F.col("new_kinds").isNull(), F.col("old_kinds").isNull()
    changes = both.select("feed", "no", "prev", F.when(gone, "removed").when(came, "added").when((F.size("new_kinds") > 0) & (F.size("old_kinds") > 0) & (F.col("new_kinds") != F.col("old_kinds")), "retyped").alias("kind"), "name").where(F.col("kind").isNotNull())
    changes = cut(changes)

    # Fields of one record type: few names went or came in a step.
    pairs = changes.where("kind = 'removed'").select("feed", "no", "prev", F.col("name").alias("old")).join(changes.where("kind = 'added'").select("feed", "no", F.col("name").alias("new")), ["feed", "no"])
    sides = cut(pairs.select("feed", F.col("prev").alias("at"), F.col("old").alias("name"), F.lit(True).alias("before"), "no", "old", "new").unionByName(pairs.select("feed", F.col("no").alias("at"), F.col("new").alias("name"), F.lit(False).alias("before"), "no", "old", "new")))
    asked = lines.withColumnRenamed("no", "at").join(small_side(sides.select("feed", "at").distinct()), ["feed", "at"], "left_semi")
    records = ingest(asked, "line", ["feed", "at"], target, strict=True)
    # A record without a whole key has no entries: a filter would be pushed down and have the lines parsed twice.
    whole = reduce(Column.__and__, (F.col(f"t_{k}").isNotNull() for k in pair_keys))
    records = records.withColumn("pair", F.when(whole, F.struct(*(F.col(f"t_{k}").alias(f"p{i}") for i, k in enumerate(pair_keys)))))
    values = held_fields(records, ["feed", "at", "pair"], target, values=True, only=F.col("pair").isNotNull()).where(F.col("kind").isNotNull())
    values = values.select("feed", "at", "pair", "name", F.struct("kind", "value").alias("value"))
    held = values.join(small_side(sides), ["feed", "at", "name"]).groupBy("feed", "no", "old", "new", "pair").agg(
        *(f(F.when(side, F.col("value"))).alias(n) for side, s in ((F.col("before"), "b"), (~F.col("before"), "a")) for f, n in ((F.min, f"{s}_lo"), (F.max, f"{s}_hi")))
    )
    held = held.where(F.col("b_lo").isNotNull() & F.col("a_lo").isNotNull())
    fits = held.groupBy("feed", "no", "old", "new").agg(F.count(F.lit(1)).alias("n"), F.min(((F.col("b_lo") == F.col("a_lo")) & (F.col("b_hi") == F.col("a_hi"))).cast("int")).alias("equal")).where("equal = 1")
    best = lambda by, other: Window.partitionBy("feed", "no", by).orderBy(F.desc("n"), other)
    renamed = fits.withColumns({"r1": F.row_number().over(best("old", "new")), "r2": F.row_number().over(best("new", "old"))}).where("r1 = 1 and r2 = 1").select("feed", "no", "old", "new")
    renamed = cut(renamed)

    taken = renamed.select("feed", "no", F.lit("removed").alias("kind"), F.col("old").alias("name")).unionByName(renamed.select("feed", "no", F.lit("added").alias("kind"), F.col("new").alias("name")))
    plain = join_null_safe(changes, taken, ["feed", "no", "kind", "name"], "left_anti")
    out = plain.select("feed", "no", "kind", "name", F.col("name").alias("new_name")).unionByName(renamed.select("feed", "no", F.lit("renamed").alias("kind"), F.col("old").alias("name"), F.col("new").alias("new_name")))
    return out.select(F.col("feed").alias(feed), F.col("no").alias(file_no), F.col("kind").alias("change_kind"), F.col("name").alias("field"), F.col("new_name").alias("new_field"))
