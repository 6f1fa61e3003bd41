"""Joins with look-up tables. Tables keep their row order in ``row_no``; the first match of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(table: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): of each key the value of the lowest row number."""
    return table.where(f"{key} IS NOT NULL AND {value} IS NOT NULL").groupBy(key).agg(F.min_by(value, "row_no").alias(value))


def all_matches(table: DataFrame, key: str, value: str) -> DataFrame:
    """(key, values): of each key all values, in row order."""
    ordered = F.array_sort(F.collect_list(F.struct("row_no", value)))
    return table.where(f"{key} IS NOT NULL").groupBy(key).agg(F.transform(ordered, lambda x: x[value]).alias("values"))


def resolve_names(rows: DataFrame, key: str, names: DataFrame, prefix: str = "ENSG", nameless: Column | None = None) -> DataFrame:
    """(key, names): lists of names (key, list) in which ids with the prefix, version cut off, become their first name.

    ``names`` (id, name) has one row an id. Order and repeats stay; ids without a name stay as they are, and so do items
    for which ``nameless`` (a condition on ``item``) holds, as those of versions that the names don't cover.
    """
    each = rows.select(key, F.posexplode("list").alias("i", "item"))
    named = F.col("item").startswith(prefix)
    if nameless is not None:
        named &= ~F.coalesce(nameless, F.lit(False))
    ident = F.when(named, F.substring_index("item", ".", 1))
    found = each.withColumn("id", ident).join(names, "id", "left").withColumn("item", F.coalesce("name", "item"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "item")))
    return found.groupBy(key).agg(F.transform(ordered, lambda x: x["item"]).alias("names"))


def mapped_or_same(rows: DataFrame, column: str, table: DataFrame, key: str, value: str, keep: Column, dropped: DataFrame | None = None) -> DataFrame:
    """Adds ``mapped``: the value where ``keep`` holds, else its look-up, else null; and null for dropped terms (term)."""
    found = rows.join(first_match(table, key, value).select(F.col(key).alias(column), F.col(value).alias("looked_up")), column, "left")
    found = found.withColumn("mapped", F.when(keep, F.col(column)).otherwise(F.col("looked_up"))).drop("looked_up")
    if dropped is not None:
        gone = dropped.select(F.col("term").alias("mapped"), F.lit(True).alias("gone")).distinct()
        found = found.join(gone, "mapped", "left").withColumn("mapped", F.when(F.col("gone").isNull(), F.col("mapped"))).drop("gone")
    return found


def flagged(rows: DataFrame, column: str, deprecated: DataFrame, dropped: tuple[str, ...] = ("MONDO",)) -> DataFrame:
    """Rows with ``deprecated``: whether their term is among deprecated ones (term); those whose id is in ``dropped`` are left out."""
    gone = deprecated.where("term IS NOT NULL").select(F.col("term").alias(column), F.lit(True).alias("deprecated")).distinct()
    found = rows.join(gone, column, "left").withColumn("deprecated", F.coalesce("deprecated", F.lit(False)))
    kind = F.regexp_extract(column, "^([A-Za-z]+)[_:]", 1)
    return found.where(~(F.col("deprecated") & F.coalesce(kind.isin(*dropped), F.lit(False))))


def pending(ids: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Ids that have no result yet."""
    return ids.select(key).distinct().join(results, key, "left_anti")


def resumed(prior: DataFrame, checkpoint: DataFrame, key: str) -> DataFrame:
    """Results with those of a checkpoint over prior ones of the same key."""
    return prior.join(checkpoint, key, "left_anti").unionByName(checkpoint)


def with_fallback(ids: DataFrame, results: DataFrame, key: str, payload: str, empty: Column) -> DataFrame:
    """Every id with its payload, or an empty one."""
    return ids.select(key).distinct().join(results, key, "left").withColumn(payload, F.coalesce(payload, empty))


def mesh_to_mondo(classes: DataFrame, overrides: DataFrame) -> DataFrame:
    """(mesh, mondo): of each class (mondo, xrefs, seq) its first MESH cross-reference, later classes over earlier ones,
    and overrides (mesh, mondo) over both."""
    first = F.get(F.filter("xrefs", lambda x: x.startswith("MESH:")), F.lit(0))
    found = classes.withColumn("mesh", first).where("mesh IS NOT NULL").groupBy("mesh").agg(F.max_by("mondo", "seq").alias("mondo"))
    return found.join(overrides, "mesh", "left_anti").unionByName(overrides.select("mesh", "mondo"))


def gene_maps(mapping: DataFrame) -> dict[str, DataFrame]:
    """The four look-ups of a gene mapping (row_no, name, ensembl, entrez): (key, values), all values in row order."""
    pairs = (("name", "ensembl"), ("ensembl", "name"), ("name", "entrez"), ("entrez", "name"))
    return {f"{a}_to_{b}": all_matches(mapping.select("row_no", a, b), a, b).withColumnRenamed(a, "key") for a, b in pairs}


def protein_maps(rows: DataFrame) -> dict[str, DataFrame]:
    """Both look-ups of protein ids (row_no, ensp, accession): (key, values), in row order."""
    pairs = (("ensp", "accession"), ("accession", "ensp"))
    return {f"{a}_to_{b}": all_matches(rows.select("row_no", a, b), a, b).withColumnRenamed(a, "key") for a, b in pairs}


def ids_of_names(names: DataFrame, mapping: DataFrame, ident: str) -> DataFrame:
    """(id): distinct ids (``ensembl`` or ``entrez``) of names (name), the first of each, sorted; Ensembl-like names count as their own id, version cut off."""
    first = first_match(mapping.select("row_no", "name", ident), "name", ident)
    found = names.join(first, "name", "left")
    own = F.when(F.col("name").contains("ENSG"), F.substring_index("name", ".", 1)) if ident == "ensembl" else F.lit(None).cast("string")
    return found.select(F.coalesce(own, ident).alias("id")).where("id IS NOT NULL").distinct().orderBy("id")


def accessions(genes: DataFrame) -> DataFrame:
    """(accession): distinct, non-empty protein names of gene records (UniProt_name)."""
    return genes.where("UniProt_name <> ''").select(F.col("UniProt_name").alias("accession")).distinct()


def with_gene_records(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows (entrez, ...) with the protein name and link of their gene record (Gene_ID, UniProt_name, Link_to_UniProt_ID), or null."""
    record = genes.select(F.col("Gene_ID").alias("entrez"), F.col("UniProt_name").alias("protein"), F.col("Link_to_UniProt_ID").alias("link"))
    return rows.join(record, "entrez", "left")
