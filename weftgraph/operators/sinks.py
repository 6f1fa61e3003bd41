"""Graphs and tuples to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.terms import edge_label
from weftgraph.operators.reports import edge_definitions
from weftgraph.plans.iterate import discard, step


#: Files and tuples of a range of ordered tuples, about: ranges come from a sample, and names give the order of four times as many files.
FILES_OF_RANGE, TUPLES_OF_RANGE = 250, 500_000


def write_tuples(tuples: DataFrame, path: str) -> None:
    """One JSON line ``{"tuples": [[...], ...]}`` per file name, in order of seq; tables go as Parquet instead."""
    cells = F.filter(F.array("s", "p", "o", "attr", "value"), lambda x: x.isNotNull())
    rows = tuples.select("file", "seq", cells.alias("t")).groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "t"))), lambda x: x["t"]).alias("tuples"))
    rows.select("tuples").write.mode("overwrite").json(path)


def write_ordered(tuples: DataFrame, path: str, per_file: int = 1_000_000) -> None:
    """Tuples (file_rank, seq, s, p, o, attr, value) as JSON lines ``{"tuples": [[...]]}`` in order, ``per_file`` at most in a file.

    Spark's ranges of (file_rank, seq) become files one after the other, and long ranges several; no file passes through
    one row or one group. Files in order of their names, line by line, give the tuples in order; parts that are null are
    left out of a tuple. Tuples are counted first: Spark numbers the files of a range with three digits, so names give the
    order of 1,000 at most, and ranges are made so many that they have about ``FILES_OF_RANGE``. Tuples alike are in one range.
    """
    cells = F.filter(F.array("s", "p", "o", "attr", "value"), lambda x: x.isNotNull())
    lines = step(tuples.select("file_rank", "seq", F.to_json(F.struct(F.array(cells).alias("tuples"))).alias("value")))
    ranges = max(-(-lines.count() // min(FILES_OF_RANGE * per_file, TUPLES_OF_RANGE)), 1)
    ordered = lines.repartitionByRange(ranges, "file_rank", "seq", "value").sortWithinPartitions("file_rank", "seq", "value")
    ordered.select("value").write.mode("overwrite").option("maxRecordsPerFile", per_file).text(path)
    discard(lines)


def write_graph(vertices: DataFrame, edges: DataFrame, folder: str) -> None:
    """Vertices and edges, partitioned by collection, and the edge definitions."""
    vertices.write.mode("overwrite").partitionBy("collection").parquet(f"{folder}/vertices")
    edges.write.mode("overwrite").partitionBy("collection").parquet(f"{folder}/edges")
    edge_definitions(edges).write.mode("overwrite").parquet(f"{folder}/definitions")


def prefer_full(part: DataFrame, full: DataFrame) -> DataFrame:
    """Documents (collection, key, attrs) with the attributes of the full graph where it has them."""
    found = part.join(full.withColumnRenamed("attrs", "full_attrs"), ["collection", "key"], "left")
    return found.select("collection", "key", F.coalesce("full_attrs", "attrs").alias("attrs"))


def node_table(vertices: DataFrame) -> DataFrame:
    """Nodes for TSV: (id, category, attributes), arrays joined by bars."""
    entries = F.array_sort(F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|"))))
    return vertices.select(F.concat_ws(":", "collection", "key").alias("id"), F.col("collection").alias("category"), F.array_join(entries, ";").alias("attributes"))


def write_tsv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").csv(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of nodes or edges written as TSV."""
    return spark.read.option("sep", "\t").option("header", True).option("quote", "").schema(schema).csv(path)


def write_lines(lines: DataFrame, column: str, path: str) -> None:
    """A text column as lines of text: label catalogues, obsolete terms, N-Triples."""
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def label_lines(labels: DataFrame) -> DataFrame:
    """``label: NORMALISED`` of distinct raw labels (label)."""
    return labels.distinct().select(F.concat_ws(": ", "label", edge_label(F.col("label"))).alias("value"))


def edge_table(edges: DataFrame) -> DataFrame:
    """Edges for TSV: (subject, predicate, object)."""
    curie = lambda c: F.replace(F.col(c), F.lit("/"), F.lit(":"))
    return edges.select(curie("src").alias("subject"), F.array_join("labels", "|").alias("predicate"), curie("dst").alias("object"))


def n_triples(edges: DataFrame, base: str) -> DataFrame:
    """One line of N-Triples for each edge and label."""
    uri = lambda c: F.concat(F.lit(f"<{base}"), F.replace(c, F.lit("/"), F.lit("_")), F.lit(">"))
    each = edges.withColumn("label", F.explode("labels"))
    return each.select(F.concat(uri(F.col("src")), F.lit(" "), uri(F.col("label")), F.lit(" "), uri(F.col("dst")), F.lit(" .")).alias("value"))


def attribute_triples(vertices: DataFrame, base: str) -> DataFrame:
    """One line of N-Triples for each value of each attribute of vertices (collection, key, attrs)."""
    each = vertices.select(F.concat_ws("_", "collection", "key").alias("term"), F.explode("attrs").alias("name", "values")).select("term", "name", F.explode("values").alias("v"))
    text = F.replace(F.replace(F.replace("v", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return each.select(F.concat(F.lit(f"<{base}"), "term", F.lit(f"> <{base}"), "name", F.lit('> "'), text, F.lit('" .')).alias("value"))


def routed(nodes: DataFrame) -> DataFrame:
    """Nodes (id as CURIE, ...) with the collection and key that their id names."""
    return nodes.withColumns({"collection": F.substring_index("id", ":", 1), "key": F.substr(F.col("id"), F.instr("id", ":") + 1)})


def write_collection(vertices: DataFrame, collection: str, path: str) -> None:
    vertices.where(F.col("collection") == collection).drop("collection").write.mode("overwrite").json(path)


def obsolete_terms(obsolete: DataFrame, load: str) -> DataFrame:
    """(load, term) of obsolete vertices, as one table over all loads."""
    return obsolete.select(F.lit(load).alias("load"), F.concat_ws("_", "collection", "key").alias("term"))
