"""Files as DataFrames: ontologies (XML), tuple files, result tables and keyed JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from weftgraph.functions import terms

ABOUT = "struct<`_rdf:resource`:string>"
CLASS_SCHEMA = (
    "`_rdf:about` string, `rdfs:label` array<struct<_VALUE:string>>, "
    f"`rdfs:subClassOf` array<struct<`_rdf:resource`:string,`owl:Restriction`:struct<`owl:onProperty`:{ABOUT},`owl:someValuesFrom`:{ABOUT}>>>, "
    "`owl:deprecated` array<struct<_VALUE:string>>, `oboInOwl:hasDbXref` array<struct<_VALUE:string>>"
)
HEADER_SCHEMA = f"`_rdf:about` string, `dc:title` struct<_VALUE:string>, `dc:description` struct<_VALUE:string>, `owl:versionIRI` {ABOUT}, `owl:versionInfo` struct<_VALUE:string>, `obo:IAO_0000700` array<{ABOUT}>, `owl:imports` array<{ABOUT}>"
# fixed values: predicates of statements that are kept, by prefix, and the one left out
KEPT_PREFIXES = ("http://www.w3.org/2000/01/rdf-schema#", "http://purl.obolibrary.org/obo/", "http://purl.org/dc/", "http://www.geneontology.org/formats/oboInOwl#")
EXCLUDED_PREDICATES = ("http://purl.obolibrary.org/obo/mondo#curated_content_resource",)
# fixed values: namespaces accepted in a file besides that of its root
EXTRA_NAMESPACES = {"cl.owl": ("http://purl.obolibrary.org/obo/PR",)}
# fixed values: labels that stand over scanned ones where a file of relations is among the files
PROPERTY_LABELS = {"RO_0002027": "has pharmacological effect", "RO_0002294": "selectively express", "RO_0020325": "evaluated in", "IAO_0000136": "is about"}
#: Elements with terms of their own.
TERM_TAGS = ("owl:Class", "owl:ObjectProperty", "owl:AnnotationProperty", "owl:DatatypeProperty", "owl:NamedIndividual")
STATEMENT = "array<struct<literal:string,resource:string>>"


def files_matching(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, name, modified) of the regular files of a folder whose name matches a pattern as a whole."""
    found = spark.read.format("binaryFile").load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("modified"))
    return found.where(F.col("name").rlike(f"^(?:{pattern})$"))


def _xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return _placed(spark.read.format("xml").option("rowTag", tag).schema(schema).load(path))


def ontology_classes(spark: SparkSession, path: str) -> DataFrame:
    """One row per named class: file, position, about, labels, parents, restrictions (property, filler), deprecated, xrefs."""
    return classes_of(_xml(spark, path, "owl:Class", CLASS_SCHEMA))


def classes_of(rows: DataFrame) -> DataFrame:
    """The classes of parsed rows of ``CLASS_SCHEMA``, their file and their position in it."""
    rows = rows.where("`_rdf:about` IS NOT NULL")
    values = lambda c: F.coalesce(F.transform(F.col(f"`{c}`"), lambda x: x["_VALUE"]), F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    parents = F.coalesce(F.array_compact(F.transform("`rdfs:subClassOf`", lambda x: x["_rdf:resource"])), none)
    pairs = F.transform("`rdfs:subClassOf`", lambda x: F.struct(x["owl:Restriction"]["owl:onProperty"]["_rdf:resource"].alias("property"), x["owl:Restriction"]["owl:someValuesFrom"]["_rdf:resource"].alias("filler")))
    whole = F.filter(pairs, lambda x: x["property"].isNotNull() & x["filler"].isNotNull())
    restrictions = F.coalesce(whole, F.array().cast("array<struct<property:string,filler:string>>"))
    return rows.select("file", "position", F.col("`_rdf:about`").alias("about"), values("rdfs:label").alias("labels"), parents.alias("parents"), restrictions.alias("restrictions"), values("owl:deprecated").alias("deprecated"), values("oboInOwl:hasDbXref").alias("xrefs"))


def statements_of(rows: DataFrame) -> DataFrame:
    """(file, position, about, element, literal, resource): each child element of elements with ``rdf:about``.

    ``rows`` are parsed elements with columns of any children, as text, structs or arrays, and ``file`` and ``position``.
    Children with elements of their own (restrictions) have neither literal nor resource and are left out.
    """

    def one(kind: DataType) -> Callable[[Column], Column]:
        none = F.lit(None).cast("string")
        if not isinstance(kind, StructType):
            return lambda value: F.struct(value.cast("string").alias("literal"), none.alias("resource"))
        part = lambda value, name: value[name].cast("string") if name in kind.names else none
        return lambda value: F.struct(part(value, "_VALUE").alias("literal"), part(value, "_rdf:resource").alias("resource"))

    each = []
    for field in rows.schema:
        if field.name in ("file", "position") or field.name.startswith("_"):
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, ArrayType):
            values = F.transform(column, one(field.dataType.elementType))
        else:
            values = F.when(column.isNotNull(), F.array(one(field.dataType)(column)))
        each.append(F.struct(F.lit(field.name).alias("element"), F.coalesce(values, F.array().cast(STATEMENT)).cast(STATEMENT).alias("values")))
    named = rows.where("`_rdf:about` IS NOT NULL").select("file", "position", F.col("`_rdf:about`").alias("about"), F.explode(F.array(*each)).alias("x"))
    found = named.select("file", "position", "about", "x.element", F.explode("x.values").alias("v")).select("file", "position", "about", "element", "v.*")
    return found.where("literal IS NOT NULL OR resource IS NOT NULL")


def ontology_statements(spark: SparkSession, path: str, tag: str = "owl:Class") -> DataFrame:
    """As ``statements_of``, for all elements of a tag in files; their children are found by a pass over the files."""
    reader = lambda: spark.read.format("xml").option("rowTag", tag)
    schema = reader().option("inferSchema", False).load(path).schema
    if "_rdf:about" not in schema.names:
        return spark.createDataFrame([], "file string, position struct<block:bigint,row:bigint>, about string, element string, literal string, resource string")
    return statements_of(_placed(reader().schema(schema).load(path)))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds a row's file and its position there."""
    position = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("*", F.col("_metadata.file_name").alias("file"), position.alias("position"))


def prefixes(spark: SparkSession, path: str) -> DataFrame:
    """(file, prefix, uri): the namespace declarations of XML files."""
    pattern = r"xmlns:([\w.-]+)\s*=\s*[\"']([^\"']*)[\"']"
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value").where(F.col("value").contains("xmlns:"))
    found = lambda k: F.regexp_extract_all("value", F.lit(pattern), F.lit(k))
    pairs = lines.select("file", F.explode(F.arrays_zip(found(1).alias("prefix"), found(2).alias("uri"))).alias("x"))
    return pairs.select("file", "x.prefix", "x.uri").distinct()


def statement_triples(statements: DataFrame, declared: DataFrame, namespaces: DataFrame, skip: tuple[str, ...] = ("ro.owl",), test_objects: bool = True) -> DataFrame:
    """Distinct (s, p, o) of statements in their file's namespaces, under kept predicates; ``declared`` is (file, prefix, uri).

    Resources must be in the namespaces too, if objects are tested; literals pass.
    """
    p = F.concat("uri", F.substr("element", F.instr("element", ":") + 1))
    rows = statements.where(~F.col("file").isin(*skip)).withColumn("prefix", F.substring_index("element", ":", 1))
    rows = rows.join(declared, ["file", "prefix"]).withColumn("p", p).join(namespaces, "file")
    kept = F.exists(F.array(*map(F.lit, KEPT_PREFIXES)), lambda x: F.col("p").startswith(x)) & ~F.col("p").isin(*EXCLUDED_PREDICATES) & inside(F.col("about"))
    if test_objects:
        kept &= F.col("literal").isNotNull() | inside(F.col("resource"))
    return rows.where(kept).select(F.col("about").alias("s"), "p", F.coalesce("literal", "resource").alias("o")).distinct()


def inside(uri: Column) -> Column:
    """Whether a URI starts with one of the row's ``namespaces``."""
    return F.exists("namespaces", lambda n: uri.startswith(n))


def ontology_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: title, description, purl, version date, root class and imported namespaces."""
    return headers_of(_xml(spark, path, "owl:Ontology", HEADER_SCHEMA))


def headers_of(rows: DataFrame) -> DataFrame:
    """The headers of parsed rows of ``HEADER_SCHEMA``, and their file."""
    root = F.get(F.transform("`obo:IAO_0000700`", lambda x: x["_rdf:resource"]), F.lit(0))
    imports = F.transform(F.coalesce("`owl:imports`", F.array().cast(f"array<{ABOUT}>")), lambda x: F.upper(F.regexp_replace(F.substring_index(x["_rdf:resource"], "/", -1), r"\.owl$", "")))
    return rows.select(
        "file",
        F.col("`dc:title`._VALUE").alias("title"),
        F.col("`dc:description`._VALUE").alias("description"),
        F.col("`_rdf:about`").alias("purl"),
        terms.version_date(F.col("`owl:versionInfo`._VALUE"), F.col("`owl:versionIRI`.`_rdf:resource`")).alias("version"),
        root.alias("root"),
        imports.alias("imports"),
    )


def root_namespaces(classes: DataFrame, headers: DataFrame) -> DataFrame:
    """(file, namespaces): what stands before the first underscore of the root, or else of the file's first class, and the file's extra ones."""
    space = lambda c: F.substring_index(c, "_", 1)
    first = classes.groupBy("file").agg(space(F.min_by("about", "position")).alias("first"))
    found = first.join(headers.select("file", space(F.col("root")).alias("root")), "file", "left")
    extra = F.coalesce(F.create_map(*[F.lit(x) for k, v in EXTRA_NAMESPACES.items() for x in (k, list(v))])[F.col("file")], F.array().cast("array<string>"))
    return found.select("file", F.array_union(F.array(F.coalesce("root", "first")), extra).alias("namespaces"))


def class_namespaces(classes: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(file, namespace, is_root): the namespaces of a file's classes, that of its root marked."""
    found = classes.where(F.col("about").contains("_")).select("file", F.substring_index("about", "_", 1).alias("namespace")).distinct()
    return found.join(namespaces, "file").select("file", "namespace", (F.col("namespace") == F.get("namespaces", F.lit(0))).alias("is_root"))


def import_report(headers: DataFrame, classes: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(file, namespace, is_root, imported, classes): the namespaces that a file's classes are in or that it imports - the last part of
    what it names - and how many classes are in each."""
    last = F.upper(F.substring_index("namespace", "/", -1))
    counted = classes.where(F.col("about").contains("_")).groupBy("file", F.substring_index("about", "_", 1).alias("namespace")).agg(F.count("*").alias("classes"))
    marked = class_namespaces(classes, namespaces).join(counted, ["file", "namespace"]).select("file", last.alias("namespace"), "is_root", "classes")
    imported = headers.select("file", F.explode("imports").alias("namespace"), F.lit(True).alias("imported")).distinct()
    both = marked.join(imported, ["file", "namespace"], "full_outer")
    return both.select("file", "namespace", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_root", "imported")], F.coalesce("classes", F.lit(0)).cast("long").alias("classes"))


def ontology_triples(classes: DataFrame, namespaces: DataFrame, skip: tuple[str, ...] = ("ro.owl",), test_objects: bool = True) -> DataFrame:
    """Distinct (s, p, o): labels, named parents and flattened restrictions of classes in their file's namespaces."""
    rdfs = terms.RDFS
    t = lambda p, o, literal: F.struct(p.alias("p"), o.alias("o"), F.lit(literal).alias("literal"))
    made = F.concat(
        F.transform("labels", lambda x: t(F.lit(rdfs + "label"), x, True)),
        F.transform("parents", lambda x: t(F.lit(rdfs + "subClassOf"), x, False)),
        F.transform("restrictions", lambda x: t(x["property"], x["filler"], False)),
    )
    rows = classes.where(~F.col("file").isin(*skip)).join(namespaces, "file")
    each = rows.where(inside(F.col("about"))).select(F.col("about").alias("s"), F.explode(made).alias("t"), "namespaces")
    kept = ~F.col("t.p").isin(*EXCLUDED_PREDICATES)
    if test_objects:
        kept &= F.col("t.literal") | inside(F.col("t.o"))
    return each.where(kept).select("s", "t.p", "t.o").distinct()


def taxon_slim(classes: DataFrame, taxon: str) -> DataFrame:
    """The classes with a restriction whose filler is the taxon."""
    return classes.where(F.exists("restrictions", lambda x: x["filler"] == taxon))


def slimmed(classes: DataFrame, headers: DataFrame, properties: DataFrame, taxon: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The slim of a taxon: its classes, the header and the properties as they are, and (file, kept) - how many classes stay."""
    kept = taxon_slim(classes, taxon)
    return kept, headers, properties, kept.groupBy("file").agg(F.count("*").alias("kept"))


def ontology_terms(spark: SparkSession, path: str, tags: tuple[str, ...] = TERM_TAGS) -> DataFrame:
    """(file, position, about, label): every element of the tags with ``rdf:about``, and its first label or null."""
    schema = "`_rdf:about` string, `rdfs:label` array<struct<_VALUE:string>>"
    rows = None
    for tag in tags:
        part = _placed(spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)).where("`_rdf:about` <> ''")
        part = part.select("file", "position", F.col("`_rdf:about`").alias("about"), F.get("`rdfs:label`", F.lit(0))["_VALUE"].alias("label"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def term_ids(found: DataFrame, invalid: tuple[str, ...] = ("valid",)) -> DataFrame:
    """(file, ids): the id prefixes of a file's terms, sorted."""
    term = F.substring_index("about", "/", -1)
    each = found.where(term.contains("_")).select("file", F.substring_index(term, "_", 1).alias("id")).where(~F.col("id").isin(*invalid)).distinct()
    return each.groupBy("file").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def term_labels(found: DataFrame, relations: str = "ro.owl") -> DataFrame:
    """(term, purl, label) of elements (file, position, about, label): of a term's labels the last one, and the fixed ones over
    scanned ones where the file of relations is among the files."""
    labelled = found.where("label IS NOT NULL").select(F.substring_index("about", "/", -1).alias("term"), "about", "label", "file", "position")
    last = labelled.groupBy("term").agg(F.max_by(F.struct(F.col("about").alias("purl"), "label"), F.struct("file", "position")).alias("x")).select("term", "x.*")
    fixed = F.array(*[F.struct(F.lit(k).alias("term"), F.lit(terms.PURL + k).alias("purl"), F.lit(v).alias("label")) for k, v in PROPERTY_LABELS.items()])
    more = found.where(F.col("file") == relations).limit(1).select(F.explode(fixed).alias("x")).select("x.*")
    return last.join(F.broadcast(more.select("term")), "term", "left_anti").unionByName(more)


def labels_to_terms(labels: DataFrame) -> DataFrame:
    """(label, term): of each label its last term by name."""
    return labels.groupBy("label").agg(F.max("term").alias("term"))


def tuple_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, arity, s, p, o, attr, value) of JSON files ``{"tuples": [[...], ...]}``, in their order.

    Quintuples are (s, p, o, attr, value); of other arities the first five parts are kept.
    """
    rows = spark.read.schema("tuples array<array<string>>").option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))
    each = rows.select("file", F.posexplode("tuples").alias("seq", "t"))
    part = lambda k: F.get("t", F.lit(k))
    return each.select("file", F.col("seq").cast("long").alias("seq"), F.size("t").alias("arity"), *[part(k).alias(c) for k, c in enumerate(("s", "p", "o", "attr", "value"))])


def ordered_tuples(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, arity, s, p, o, attr, value) of files of JSON lines ``{"tuples": [[...], ...]}``; (file, position) is their order."""
    rows = _placed(spark.read.schema("tuples array<array<string>>").json(path))
    each = rows.select("file", "position", F.posexplode("tuples").alias("n", "t"))
    part = lambda k: F.get("t", F.lit(k))
    place = F.struct("position.block", "position.row", F.col("n").alias("n")).alias("position")
    return each.select("file", place, F.size("t").alias("arity"), *[part(k).alias(c) for k, c in enumerate(("s", "p", "o", "attr", "value"))])


def result_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV result table with a header and a leading index column, and a deterministic id where ``uuid`` is missing."""
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    rows = rows.drop(*[c for c in rows.columns if c.startswith("_c")])
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns if c != "uuid"]
    ident = terms.short_id(*keys)
    return rows.withColumn("uuid", F.coalesce(F.col("uuid"), ident) if "uuid" in rows.columns else ident)


def keyed_json(spark: SparkSession, path: str, listed: str) -> DataFrame:
    """(id, payload variant) of JSON files that hold payloads by id, and the list of ids under one key of its own."""
    rows = spark.read.format("text").option("wholetext", True).load(path)
    return rows.select(F.try_parse_json("value").alias("v")).lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).where(F.col("key") != listed).select(F.col("key").alias("id"), F.col("value").alias("payload"))


def graph_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of a written graph, system fields left out of the attributes."""
    vertices, edges = (spark.read.parquet(f"{folder}/{name}") for name in ("vertices", "edges"))
    hidden = ("_id", "_key", "_rev", "_from", "_to")
    strip: Column = F.map_filter("attrs", lambda k, v: ~k.isin(*hidden))
    return vertices.withColumn("attrs", strip), edges


def combined_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of CSV files with headers, columns by name; what a file lacks is null."""
    first, *rest = [spark.read.option("header", True).option("escape", '"').csv(path) for path in paths]
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first.drop(*[c for c in first.columns if c.startswith("_c")])


def gene_mapping(rows: DataFrame, columns: tuple[str, ...] = ("external_gene_name", "ensembl_gene_id", "entrezgene_id")) -> DataFrame:
    """(row_no, name, ensembl, entrez) of a mapping's complete, distinct rows, ids as text; ``rows`` have their place in ``row_no``."""
    name, ensembl, entrez = columns
    whole = rows.where(" AND ".join(f"{c} IS NOT NULL" for c in columns))
    number = F.when(F.col(entrez).rlike(r"^\d+\.0$"), F.substring_index(F.col(entrez).cast("string"), ".", 1)).otherwise(F.col(entrez).cast("string"))
    made = whole.select("row_no", F.col(name).cast("string").alias("name"), F.col(ensembl).cast("string").alias("ensembl"), number.alias("entrez"))
    return made.groupBy("name", "ensembl", "entrez").agg(F.min("row_no").alias("row_no")).select("row_no", "name", "ensembl", "entrez")


def anatomical_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Structures (id, label, part_of) and cell types (id, located_in) of JSON files ``{"data": {...}}``."""
    schema = "data struct<anatomical_structures:array<struct<id:string,ccf_pref_label:string,ccf_part_of:array<string>>>,cell_types:array<struct<id:string,ccf_located_in:array<string>>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    structures = rows.select(F.explode("data.anatomical_structures").alias("x")).select("x.id", F.col("x.ccf_pref_label").alias("label"), F.col("x.ccf_part_of").alias("part_of"))
    return structures, rows.select(F.explode("data.cell_types").alias("x")).select("x.id", F.col("x.ccf_located_in").alias("located_in"))


ANNOTATIONS = "id string, subject string, subject_type string, subject_name string, subject_identifier string, relation string, object string, object_type string, object_name string, object_identifier string"


def annotation_records(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Relations between named things of JSON files, with their file: arrays of records, or a record in each line.

    Files of lines are split over tasks; an array is read by one. Records without an id get one made of all their parts.
    """
    rows = spark.read.schema(ANNOTATIONS).option("multiLine", not lines).json(path).withColumn("file", F.col("_metadata.file_name"))
    parts = [F.coalesce(c, F.lit("")) for c in rows.columns if c not in ("id", "file")]
    return rows.withColumn("id", F.coalesce("id", terms.short_id(*parts)))
