"""Slims of ontologies as files: classes in a taxon, with the header and the properties as they are, without axioms.

Files are read as pieces that each begin at a class's opening tag, so no file passes through one row. How deep a piece
begins follows from running counts of opening and closing tags over a file's pieces - numbers only, without the texts - and
tells which pieces belong to one top-level class, and where that class ends. What stands between classes passes through,
but for axioms. Pieces are put in order again by ranges and written as they were.

Defined cases: classes within classes or restrictions belong to the top-level one; classes without ``rdf:about`` pass
through; an empty class ends with its tag; axioms may hold classes; a file without classes passes through as a whole;
opening tags of classes and axioms are not looked for inside comments or CDATA.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftgraph.functions.terms import PURL
from weftgraph.plans.iterate import step
from weftgraph.sources import files

OPEN, CLOSE = "<owl:Class", "</owl:Class>"
#: An opening tag goes on with white space or ends; ``<owl:Classes`` is none.
_TAG = r"^[\s/>]"
_AXIOM = r"(?s)<owl:Axiom[\s>].*?</owl:Axiom>\s*"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, text): what stands before the first class, and from each class's opening tag to the next one's."""
    rows = spark.read.option("lineSep", OPEN).text(path)
    return rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.col("value").alias("text"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def elements(spark: SparkSession, path: str, taxon: str) -> DataFrame:
    """(file, place, kind, kept, xml): top-level classes (kept or not) and the rest of the files, in order of place, axioms taken out."""
    uri = f"{PURL}NCBITaxon_{taxon}"
    text = F.col("text")
    order = Window.partitionBy("file").orderBy("block", "row")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    read = step(_pieces(spark, path))
    empty = text.rlike(_TAG) & text.rlike(r"^[^>]*/>")
    # numbers alone are brought together by file
    numbers = read.select("file", "block", "row", text.rlike(_TAG).alias("opens"), empty.alias("empty"), _count(text, CLOSE).alias("closed"), _count(text, r"<owl:Axiom[\s>]").alias("axioms"), _count(text, "</owl:Axiom>").alias("axioms_ended"))
    numbers = numbers.withColumn("place", F.row_number().over(order)).withColumn("opens", (F.col("place") > 1) & F.col("opens"))
    before = lambda value: F.coalesce(F.sum(value).over(so_far), F.lit(0))
    numbers = numbers.withColumns({"depth": before((F.col("opens") & ~F.col("empty")).cast("int") - F.col("closed")), "inside": before(F.col("axioms") - F.col("axioms_ended")) > 0})
    numbers = numbers.withColumn("starts", F.col("opens") & (F.col("depth") == 0) & ~F.col("inside"))
    numbers = numbers.withColumn("class", F.sum(F.col("starts").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = read.join(numbers, ["file", "block", "row"])
    whole = F.when(F.col("place") > 1, F.concat(F.lit(OPEN), "text")).otherwise(text)
    # how many closing tags end the class here; none where it began elsewhere and has ended, or goes on
    ends = F.col("depth") + (F.col("opens") & ~F.col("empty")).cast("int")
    first_tag = F.regexp_extract(whole, r"^[^>]*>", 0)
    own = (
        F.when(F.col("starts") & F.col("empty"), first_tag)
        .when(~F.col("inside") & (F.col("starts") | (F.col("depth") > 0)) & (F.col("closed") >= ends), F.concat(F.call_function("substring_index", whole, F.lit(CLOSE), ends.cast("int")), F.lit(CLOSE)))
        .when(~F.col("inside") & (F.col("starts") | (F.col("depth") > 0)), whole)
        .otherwise("")
    )
    rest = F.substr("whole", F.char_length("own") + 1)
    between = F.when(F.col("inside"), F.when(F.col("axioms_ended") > 0, F.substr("whole", F.instr("whole", "</owl:Axiom>") + len("</owl:Axiom>"))).otherwise("")).otherwise(rest)
    # an axiom that is open where the piece ends goes on in the next one
    outside = F.regexp_replace(F.regexp_replace(between, _AXIOM, ""), r"(?s)<owl:Axiom[\s>].*$", "")
    cut = pieces.withColumn("whole", whole).withColumn("own", own)
    classes = cut.where("own <> ''").groupBy("file", "class").agg(F.min("place").alias("place"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "own"))), lambda x: x["own"]), "").alias("xml"))
    named = F.col("xml").rlike(r"^<owl:Class\s[^>]*rdf:about\s*=")
    wanted = F.col("xml").rlike(rf"<owl:someValuesFrom\s[^>]*rdf:resource\s*=\s*[\"']{uri.replace('.', '[.]')}[\"']")
    found = classes.select("file", F.struct("place", F.lit(0).alias("part")).alias("place"), F.when(named, "class").otherwise("other").alias("kind"), (~named | wanted).alias("kept"), "xml")
    others = cut.select("file", F.struct("place", F.lit(1).alias("part")).alias("place"), F.lit("other").alias("kind"), F.lit(True).alias("kept"), outside.alias("xml"))
    return found.unionByName(others.where(F.col("xml").rlike(r"\S")))


def write_slim(spark: SparkSession, source: str, path: str, taxon: str, per_file: int = 100_000) -> DataFrame:
    """Writes the slim of each file of ``source`` under ``path/file=NAME``, in parts in order; (file, written, skipped) classes.

    Parts one after the other are the document. A part alone has no root around it, so a parser of documents ends after its
    first class; ``classes``, ``headers`` and ``terms`` read parts.
    """
    found = step(elements(spark, source, taxon))
    ordered = found.where("kept").repartitionByRange("file", "place").sortWithinPartitions("file", "place")
    ordered.select("file", F.col("xml").alias("value")).write.mode("overwrite").partitionBy("file").option("maxRecordsPerFile", per_file).text(path)
    return found.groupBy("file").agg(F.count_if((F.col("kind") == "class") & F.col("kept")).alias("written"), F.count_if((F.col("kind") == "class") & ~F.col("kept")).alias("skipped"))


def classes(spark: SparkSession, path: str) -> DataFrame:
    """As ``files.ontology_classes``, of the parts of slims."""
    found = elements(spark, path, "").where("kind = 'class'").select("file", F.col("place").alias("position"), F.from_xml("xml", files.CLASS_SCHEMA).alias("x"))
    return files.classes_of(found.select("file", "position", "x.*"))


def _between(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements of a tag that stand between the classes of the parts of slims, parsed by a schema."""
    inner = F.regexp_replace("xml", r"<[?!][^>]*>|</?rdf:RDF[^>]*>", "")
    parsed = F.from_xml(F.concat(F.lit("<all>"), inner, F.lit("</all>")), f"`{tag}` array<struct<{schema}>>")
    rows = elements(spark, path, "").where("kind = 'other'").where(F.contains("xml", F.lit(f"<{tag}")))
    return rows.select("file", F.col("place").alias("position"), F.posexplode(parsed[tag]).alias("n", "x")).select("file", F.struct("position", "n").alias("position"), "x.*")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """As ``files.ontology_headers``, of the parts of slims."""
    return files.headers_of(_between(spark, path, "owl:Ontology", files.HEADER_SCHEMA))


def terms(spark: SparkSession, path: str, tags: tuple[str, ...]) -> DataFrame:
    """As ``files.ontology_terms``, of the parts of slims, for tags other than classes."""
    out = None
    for tag in tags:
        rows = _between(spark, path, tag, "`_rdf:about` string, `rdfs:label` array<struct<_VALUE:string>>").where("`_rdf:about` <> ''")
        made = rows.select("file", "position", F.col("`_rdf:about`").alias("about"), F.get("`rdfs:label`", F.lit(0))["_VALUE"].alias("label"))
        out = made if out is None else out.unionByName(made)
    return out
