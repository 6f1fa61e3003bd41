"""Raw payloads of remote records to flat fields. Payloads are JSON text or variants by id, or compressed XML."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weftgraph.functions import terms


@F.pandas_udf(StringType())
def gunzipped(payload: pd.Series) -> pd.Series:
    """Text of gzip data, a batch at a time; Spark SQL has no such function. Null for null or broken data."""

    def one(data: bytes | None) -> str | None:
        try:
            return gzip.decompress(data).decode() if data is not None else None
        except (OSError, EOFError, UnicodeDecodeError):
            return None

    return payload.map(one)


def decoded(base64_text: Column) -> Column:
    return gunzipped(F.try_to_binary(base64_text, F.lit("base64")))


def at(variant: Column, path: str, kind: str = "string") -> Column:
    """A nested value, or null where a key on the way is missing."""
    return F.try_variant_get(variant, path, kind)


def dataset_fields(raw: DataFrame) -> DataFrame:
    """Datasets (id, dataset variant, collection variant) to fields; rows that lack either document are left out."""
    d, c = F.col("dataset"), F.col("collection")
    authors = at(c, "$.publisher_metadata.authors", "array<struct<family:string,given:string>>")
    year, journal = at(c, "$.publisher_metadata.published_year"), at(c, "$.publisher_metadata.journal")
    said = terms.citation_links(F.coalesce(at(d, "$.citation"), at(c, "$.citation")))
    labels = lambda key: terms.collected(at(d, f"$.{key}", "array<struct<label:string>>"), "label")
    listed = F.array_join(F.transform(authors, lambda a: F.concat(F.coalesce(a["family"], F.lit("")), F.lit(", "), F.coalesce(a["given"], F.lit("")))), ", ")
    return raw.where("dataset IS NOT NULL AND collection IS NOT NULL").select(
        "id",
        F.concat(F.get(authors, F.lit(0))["family"], F.lit(" ("), year, F.lit(") "), journal).alias("Citation"),
        F.when(F.size(authors) > 0, listed).alias("Author_list"),
        year.alias("Year"),
        at(c, "$.name").alias("Title"),
        journal.alias("Journal"),
        said["publication"].alias("Link_to_publication"),
        said["collection"].alias("Link_to_CELLxGENE_collection"),
        at(d, "$.assets[0].url").alias("Link_to_CELLxGENE_dataset"),
        at(d, "$.title").alias("Dataset_name"),
        at(d, "$.cell_count", "bigint").alias("Number_of_cells"),
        *[labels(k).alias(n) for k, n in (("organism", "Organism"), ("tissue", "Tissue"), ("disease", "Disease_status"))],
        *[at(d, f"$.{k}").alias(n) for k, n in (("collection_id", "Collection_ID"), ("collection_version_id", "Collection_version_ID"), ("dataset_id", "Dataset_ID"))],
        F.col("id").alias("Dataset_version_ID"),
    )


def protein_fields(raw: DataFrame) -> DataFrame:
    """Protein records (id, payload variant) to fields; of several functions the last one's first text."""
    p = F.col("payload")
    comments = F.filter(at(p, "$.comments", "array<struct<commentType:string,texts:array<struct<value:string>>>>"), lambda x: (x["commentType"] == "FUNCTION") & (F.size(x["texts"]) > 0))
    return raw.select(
        "id",
        at(p, "$.proteinDescription.recommendedName.fullName.value").alias("Protein_name"),
        at(p, "$.primaryAccession").alias("UniProt_ID"),
        at(p, "$.genes[0].geneName.value").alias("Gene_name"),
        at(p, "$.sequence.length", "bigint").alias("Number_of_amino_acids"),
        F.get(F.try_element_at(comments, F.lit(-1))["texts"], F.lit(0))["value"].alias("Function"),
        at(p, "$.annotationScore", "double").alias("Annotation_score"),
        at(p, "$.organism.scientificName").alias("Organism"),
    )


# fixed values: resources of a target record
TARGET_RESOURCES = ("diseases", "drugs", "interactions", "pharmacogenetics", "tractability", "expression", "depmap")


def target_fields(raw: DataFrame) -> DataFrame:
    """Target records (id, payload variant) to the target and its resources, which stand under ``rows`` or directly."""
    p = F.col("payload")
    rows = lambda k: F.coalesce(at(p, f"$.{k}.rows", "variant"), at(p, f"$.{k}", "variant"))
    return raw.where(at(p, "$.target.id").isNotNull()).select("id", at(p, "$.target", "variant").alias("target"), *[rows(k).alias(k) for k in TARGET_RESOURCES])


def gene_fields(raw: DataFrame) -> DataFrame:
    """Gene records (id, xml) to fields, by XPath."""
    text = lambda path: F.nullif(F.xpath_string("xml", F.lit(path)), F.lit(""))
    texts = lambda path: F.xpath("xml", F.lit(path + "/text()"))
    name = "//Gene-ref_formal-name//Gene-nomenclature_"
    links = F.filter(texts("//Other-source_url"), lambda x: x.contains("www.uniprot.org"))
    headings = F.filter(texts("//Gene-commentary_heading"), lambda x: x.contains("GCF_"))
    mrna = "(//Gene-commentary_products[.//Gene-commentary_type/@value='mRNA'])[1]//Gene-commentary_accession"
    last = lambda mark: F.try_element_at(F.filter(texts(mrna), lambda x: x.contains(mark)), F.lit(-1))
    description = text("//Entrezgene_prot//Prot-ref_desc")
    return raw.select(
        "id",
        F.col("id").alias("Gene_ID"),
        text(name + "symbol").alias("Official_symbol"),
        text(name + "name").alias("Official_full_name"),
        text("//Entrezgene_type/@value").alias("Gene_type"),
        F.try_element_at(links, F.lit(-1)).alias("Link_to_UniProt_ID"),
        text("//Entrezgene_source//Org-ref_taxname").alias("Organism"),
        F.nullif(F.regexp_extract(F.try_element_at(headings, F.lit(-1)), r":\s*(GCF_.*)", 1), F.lit("")).alias("RefSeq_gene_ID"),
        texts("//Gene-ref_syn_E").alias("Also_known_as"),
        text("//Entrezgene_summary").alias("Summary"),
        terms.last_accession(links).alias("UniProt_name"),
        F.concat(last("NM_"), F.lit(" -> "), last("NP_"), F.lit(", "), description).alias("mRNA_(NM)_and_protein_(NP)_sequences"),
    )


def columnar_row(raw: DataFrame, row_key: str = "0") -> DataFrame:
    """(id, field, value) of payloads ``{column: {row: value}}``: the named row, or else the column's first one."""
    fields = raw.lateralJoin(raw.sparkSession.tvf.variant_explode(F.col("payload").outer())).select("id", F.col("key").alias("field"), F.col("value").alias("cells"))
    cells = fields.lateralJoin(raw.sparkSession.tvf.variant_explode(F.col("cells").outer())).select("id", "field", "pos", "key", "value")
    best = F.min_by("value", F.struct(F.when(F.col("key") == row_key, 0).otherwise(1), F.col("pos")))
    return cells.groupBy("id", "field").agg(best.cast("string").alias("value"))
