"""Counts, scores, differences and catalogues of graphs and tuple sets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.plans.iterate import discard, step


def collection_summary(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, collection, n): members of each collection, and the total of each kind under a null collection."""
    both = vertices.select(F.lit("vertex").alias("kind"), "collection").union(edges.select(F.lit("edge"), "collection"))
    return both.groupingSets([["kind", "collection"], ["kind"]], "kind", "collection").agg(F.count("*").alias("n"))


def edge_definitions(edges: DataFrame) -> DataFrame:
    """Of each edge collection, the vertex collections it joins."""
    of = lambda end: F.array_sort(F.collect_set(F.substring_index(end, "/", 1)))
    return edges.groupBy("collection").agg(of("src").alias("from_collections"), of("dst").alias("to_collections"))


def triple_type_counts(triples: DataFrame, kind: Column) -> DataFrame:
    """How many triples have each kind of object under each predicate."""
    return triples.select("p", kind.alias("o_kind")).groupBy("p", "o_kind").agg(F.count("*").alias("n"))


def tuple_classes(tuples: DataFrame, annotation: str, source: str) -> DataFrame:
    """Tuples (arity, p, attr, o) by class - relationship, source, vertex or edge annotation - and predicate, counted."""
    kind = (
        F.when((F.col("arity") == 5) & (F.col("attr") == source), "source")
        .when(F.col("arity") == 5, "edge_annotation")
        .when(F.col("p").startswith(annotation), "vertex_annotation")
        .otherwise("relationship")
    )
    return tuples.groupBy(kind.alias("kind"), F.coalesce("attr", "p").alias("predicate")).agg(F.count("*").alias("n"))


def dataset_scores(rows: DataFrame, group: list[str], measure: str, score: str) -> DataFrame:
    """Of each group: medians, score sqrt(((measure + 1) / 2) * score), its rank, and 2 (n - median n) / IQR over groups."""
    each = rows.groupBy(*group).agg(F.median(measure).alias("m"), F.median(score).alias("f"), F.count("*").alias("n"))
    each = each.withColumn("dataset_score", F.sqrt((F.col("m") + 1) / 2 * F.col("f")))
    spread = each.agg(F.median("n").alias("mid"), F.percentile("n", F.lit(0.25)).alias("q1"), F.percentile("n", F.lit(0.75)).alias("q3"))
    ranked = each.withColumn("rank", F.rank().over(Window.orderBy(F.desc("dataset_score"))))  # one row a group
    deviation = F.try_divide(2 * (F.col("n") - F.col("mid")), F.col("q3") - F.col("q1"))
    return ranked.crossJoin(F.broadcast(spread)).select(*group, "n", "dataset_score", "rank", deviation.alias("deviation"))  # one row of spread


def field_coverage(frame: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, total): how many rows have each field."""
    counted = frame.agg(F.count("*").alias("total"), *[F.count(c).alias(c) for c in fields])
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in fields])
    return counted.select(F.explode(pairs).alias("x"), "total").select("x.field", "x.filled", "total")


def set_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two sets with the side they are on: both, old or new. Repeats and sides are settled by one aggregation."""
    columns = old.columns
    sides = old.withColumn("_o", F.lit(True)).unionByName(new.withColumn("_o", F.lit(False)))
    side = F.when(F.max("_o") != F.min("_o"), "both").when(F.max("_o"), "old").otherwise("new")
    return sides.groupBy(*columns).agg(side.alias("side"))


def keyed_difference(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, path, problem, old, new): missing and extra keys, and fields that differ."""

    def flat(frame: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("path"), F.col(c).cast("string").alias("value")) for c in fields])
        return frame.select(key, F.explode(pairs).alias("x")).select(key, "x.path", "x.value")

    o, n = flat(old).withColumnRenamed("value", "old").withColumn("in_old", F.lit(True)), flat(new).withColumnRenamed("value", "new").withColumn("in_new", F.lit(True))
    both = o.join(n, [key, "path"], "full_outer")
    problem = F.when(F.col("in_new").isNull(), "missing").when(F.col("in_old").isNull(), "extra").when(~F.col("old").eqNullSafe(F.col("new")), "value")
    return both.select(key, "path", problem.alias("problem"), "old", "new").where("problem IS NOT NULL")


def examples(frame: DataFrame, group: str, key: str, seed: int = 0) -> DataFrame:
    """One row of each group, chosen by a hash of key and seed."""
    order = F.struct(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key))
    return frame.groupBy(group).agg(F.min_by(F.struct(*[c for c in frame.columns if c != group]), order).alias("x")).select(group, "x.*")


def components_of_triples(triples: DataFrame) -> DataFrame:
    """(role, type, n, names, identifiers): of each type on either side, how many rows and the distinct names and identifiers, sorted; and of
    each relation, if there are any, how many rows. What ``triples`` lack of ``relation`` and of either side's ``_identifier`` stays empty."""
    none = F.lit(None).cast("string")
    column = lambda c: F.col(c) if c in triples.columns else none
    sides = [triples.select(F.lit(s).alias("role"), F.col(f"{s}_type").alias("type"), F.col(f"{s}_name").alias("name"), column(f"{s}_identifier").alias("ident")) for s in ("subject", "object")]
    if "relation" in triples.columns:
        sides.append(triples.select(F.lit("relation"), "relation", none, none))
    both = reduce(DataFrame.union, sides)
    found = lambda c: F.array_sort(F.collect_set(c))
    return both.groupBy("role", "type").agg(F.count("*").alias("n"), found("name").alias("names"), found("ident").alias("identifiers"))


def blank_node_triples(statements: DataFrame) -> DataFrame:
    """(bnode, s, p, o) of blank nodes (bnode, role, value) whose statements are exactly one subject, predicate and object."""
    of = lambda role: F.max(F.when(F.col("role") == role, F.col("value"))).alias(role)
    each = statements.groupBy("bnode").agg(F.count("*").alias("n"), of("s"), of("p"), of("o"))
    return each.where("n = 3 AND s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL").select("bnode", "s", "p", "o")


def newest(files: DataFrame, stem: str, version: str) -> DataFrame:
    """Files with ``current``: whether theirs is the newest version of its stem (ties: the greatest name)."""
    top = Window.partitionBy(stem).orderBy(F.desc(version), F.desc("name"))
    return files.withColumn("current", F.row_number().over(top) == 1)


def flattened(rows: DataFrame, key: str, payload: str, depth: int = 6) -> DataFrame:
    """(key, path, type, value) of the leaves of variant payloads, and of lists their length (path ``[]``); nested ``depth`` deep at most."""
    spark, out = rows.sparkSession, None
    level = rows.select(key, F.lit("$").alias("path"), F.col(payload).alias("v"))
    for _ in range(depth + 1):
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        level = level.withColumn("type", kind)
        leaf = level.where(~F.col("type").isin("OBJECT", "ARRAY")).select(key, "path", "type", F.col("v").cast("string").alias("value"))
        size = F.size(F.try_variant_get("v", "$", "array<variant>"))
        lists = level.where("type = 'ARRAY'").select(key, F.concat("path", F.lit("[]")).alias("path"), F.lit("LENGTH").alias("type"), size.cast("string").alias("value"))
        found = leaf.unionByName(lists)
        out = found if out is None else out.unionByName(found)
        inner = level.where(F.col("type").isin("OBJECT", "ARRAY")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        name = F.when(F.col("key_").isNull(), F.concat(F.lit("["), F.col("pos"), F.lit("]"))).otherwise(F.concat(F.lit("."), "key_"))
        level = inner.toDF(key, "path", "v", "type", "pos", "key_", "value").select(key, F.concat("path", name).alias("path"), F.col("value").alias("v"))
    return out


def nested_difference(old: DataFrame, new: DataFrame, key: str, payload: str) -> DataFrame:
    """(key, path, problem, old, new): where two sets of payloads differ - missing or extra paths, types, lengths, values."""
    return _differences(flattened(old, key, payload), flattened(new, key, payload), key)


def _differences(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    o = old.select(key, "path", F.col("type").alias("old_type"), F.col("value").alias("old"))
    n = new.select(key, "path", F.col("type").alias("new_type"), F.col("value").alias("new"))
    problem = (
        F.when(F.col("new_type").isNull(), "missing")
        .when(F.col("old_type").isNull(), "extra")
        .when(F.col("old_type") != F.col("new_type"), "type")
        .when(~F.col("old").eqNullSafe(F.col("new")), F.when(F.col("old_type") == "LENGTH", "length").otherwise("value"))
    )
    return o.join(n, [key, "path"], "full_outer").select(key, "path", problem.alias("problem"), "old", "new").where("problem IS NOT NULL")


def most_common(rows: DataFrame, column: str, most: int = 10) -> DataFrame:
    """(value, n): the values that stand most often, ties by value. The limit is the feature."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(most)


def statement_kinds(triples: DataFrame, kind: Callable[[str], Column]) -> DataFrame:
    """(s_kind, p, o_kind, n): how many triples have each kind of subject and object under each predicate."""
    return triples.groupBy(kind("s").alias("s_kind"), "p", kind("o").alias("o_kind")).agg(F.count("*").alias("n"))


# fixed values: fragments of predicates by what their triples describe: a relation of classes (subject, predicate, object), an
# annotation of one, and what else is said of it
RELATION = ("subClassOf", "onProperty", "someValuesFrom")
ANNOTATION = ("annotatedSource", "annotatedProperty", "annotatedTarget")
SAID = ("hasDbXref", "source")


def bnode_sets(triples: DataFrame, is_class: Callable[[Column], Column] = lambda node: F.lit(False)) -> DataFrame:
    """Triples (s, p, o) with a blank node (``_:``) on one side, with that ``bnode``, the other ``node`` and the ``kind``: relation,
    annotation, literal, class or other; with one on both sides, the kind is nested and ``bnode`` the subject. A triple is of
    one set; ``is_class`` tells classes from other nodes."""
    blank = lambda c: F.coalesce(F.col(c).startswith("_:"), F.lit(False))
    fragment = F.regexp_extract("p", r"([^/#]*)$", 1)
    kind = (
        F.when(blank("s") & blank("o"), "nested").when(fragment.isin(*RELATION), "relation").when(fragment.isin(*ANNOTATION), "annotation").when(fragment.isin(*SAID), "literal")
        .when(is_class(F.col("s")) | is_class(F.col("o")), "class").otherwise("other")
    )
    some = triples.where(blank("s") | blank("o"))
    return some.select(F.when(blank("s"), F.col("s")).otherwise(F.col("o")).alias("bnode"), F.when(blank("s"), F.col("o")).otherwise(F.col("s")).alias("node"), kind.alias("kind"), fragment.alias("fragment"), "s", "p", "o")


def bnode_triples(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The triples (kind, s, p, o) that sets of blank nodes describe, and the triples (kind, s, p, o) that they ignore.

    A set of relations or of annotations makes a triple if it has exactly three members that name its subject, predicate and
    object; literals beside annotations are said of the annotated subject. Other sets are ignored as a whole, as are
    literals without annotations that hold, classes, nested and other triples. Sets are counted before rows meet; a blank
    node with very many triples is no hot key, as its rows are joined with one row of counts.
    """
    of = lambda name: F.max(F.when(F.col("fragment") == name, F.col("node")))
    names = {"relation": RELATION, "annotation": ANNOTATION}
    good = None
    for kind, parts in names.items():
        each = sets.where(F.col("kind") == kind).groupBy("bnode").agg(F.count("*").alias("n"), *[of(p).alias(c) for p, c in zip(parts, ("x", "y", "z"))])
        each = each.where("n = 3 AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL").select(F.lit(kind).alias("kind"), "bnode", "x", "y", "z")
        good = each if good is None else good.unionByName(each)
    made = good.select("kind", F.col("x").alias("s"), F.col("y").alias("p"), F.col("z").alias("o"))
    owner = good.where("kind = 'annotation'").select("bnode", F.col("x").alias("owner"))
    said = sets.where("kind = 'literal'")
    literals = said.join(owner, "bnode").select(F.lit("literal").alias("kind"), F.col("owner").alias("s"), "p", "o")
    whole = sets.where(F.col("kind").isin(*names)).join(good.select("kind", "bnode"), ["kind", "bnode"], "left_anti")
    rest = sets.where(F.col("kind").isin("class", "other", "nested"))
    columns = ("kind", "s", "p", "o")
    ignored = whole.select(*columns).unionByName(said.join(owner, "bnode", "left_anti").select(*columns)).unionByName(rest.select(*columns))
    return made.unionByName(literals), ignored


#: Payloads that one task takes apart, about: a file of few bytes may hold very many.
PAYLOADS_OF_TASK = 10_000


def leaves(rows: DataFrame, key: str, payload: str, names: tuple[str, ...] = ("id",)) -> DataFrame:
    """(key, path, type, value) of the leaves of variant payloads at any depth, lists taken as bags.

    Members of lists are named by what they are, not by where they stand: an object that has one of ``names`` by the first one
    it has (``[id=x]``), a scalar by its value (``[x]``), anything else as ``[]``. Leaves of one path are counted: ``value`` is
    the value, the bag of values in order, or for a member of a list how often it is there. Each level is a job, until none is left.
    """
    spark, found = rows.sparkSession, []
    level = rows.repartition(rows.count() // PAYLOADS_OF_TASK + 1, key)
    level = step(level.select(key, F.lit("$").alias("path"), F.col(payload).alias("v")))
    while True:
        kind = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
        typed = level.withColumn("type", kind)
        found.append(typed.where(~F.col("type").isin("OBJECT", "ARRAY")).select(key, "path", "type", F.col("v").cast("string").alias("value")))
        found.append(typed.where("type = 'ARRAY'").select(key, F.concat("path", F.lit("[]")).alias("path"), F.lit("LENGTH").alias("type"), F.size(F.try_variant_get("v", "$", "array<variant>")).cast("string").alias("value")))
        inner = typed.where(F.col("type").isin("OBJECT", "ARRAY")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        inner = inner.toDF(key, "path", "v", "type", "pos", "key_", "value")
        named = F.coalesce(*[F.concat(F.lit(f"[{n}="), F.try_variant_get("value", f"$.{n}", "string"), F.lit("]")) for n in names])
        inside = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
        scalar = F.when(~inside.isin("OBJECT", "ARRAY"), F.concat(F.lit("["), F.coalesce(F.col("value").cast("string"), F.lit("null")), F.lit("]")))
        name = F.when(F.col("key_").isNotNull(), F.concat(F.lit("."), "key_")).otherwise(F.coalesce(F.when(inside == "OBJECT", named), scalar, F.lit("[]")))
        after = step(inner.select(key, F.concat("path", name).alias("path"), F.col("value").alias("v")))
        if after.isEmpty():
            discard(after)
            break
        level = after
    each = reduce(DataFrame.unionByName, found)
    bag = F.array_sort(F.collect_list(F.coalesce("value", F.lit("null"))))  # as many as a payload has members under one path
    return each.groupBy(key, "path").agg(F.min("type").alias("type"), F.when(F.count("*") == 1, F.min("value")).otherwise(F.array_join(bag, ",")).alias("value"))


def bag_difference(old: DataFrame, new: DataFrame, key: str, payload: str, names: tuple[str, ...] = ("id",)) -> DataFrame:
    """As ``nested_difference``, with lists compared as bags of members, at any depth."""
    return _differences(leaves(old, key, payload, names), leaves(new, key, payload, names), key)
