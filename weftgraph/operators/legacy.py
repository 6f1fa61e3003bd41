"""Older rules and writers that still have inputs: protein terms, annotations of articles, legacy relations and field dumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.operators import writers as T
from weftgraph.operators.lookups import first_match

# fixed values: publications that annotations name by number
PUBLICATIONS = {"37824655": "10.1126/science.adf6812", "37516747": "10.1038/s41467-023-40173-5", "37291214": "10.1038/s41591-023-02327-2", "38014002": "10.1101/2023.11.07.566105"}
# fixed values: characters and names that are written in another way
CHARACTERS = {"\u03b3\u03b4": "gamma-delta", "\u2212": "-"}
GENE_NAMES = {"Myelin basic protein": "MBP"}


def protein_terms(rows: DataFrame, column: str, accessions: DataFrame) -> DataFrame:
    """Adds ``protein_term``: ``PR_`` and the id, Ensembl ids as their first accession (row_no, ensp, accession), or null."""
    found = rows.join(first_match(accessions, "ensp", "accession").withColumnRenamed("ensp", column), column, "left")
    accession = F.when(F.col(column).contains("ENSP"), F.col("accession")).otherwise(F.col(column))
    return found.withColumn("protein_term", F.concat(F.lit("PR_"), accession)).drop("accession")


def filled_node(subject: Column, object_: Column, blank: Column) -> Column:
    """Of two nodes with one blank, the one that isn't."""
    return F.when(blank, object_).otherwise(subject)


def filled_triples(triples: DataFrame) -> DataFrame:
    """Triples (s, p, o) neither end of which is a blank node (``_:``)."""
    return triples.where(~F.col("s").startswith("_:") & ~F.col("o").startswith("_:"))


def concept_value(concepts: Column, name: str) -> Column:
    """The value of the first concept (propName, propValue) of a name; null if there is none."""
    return F.get(F.filter(concepts, lambda x: x["propName"] == name), F.lit(0))["propValue"]


def cell_terms(mappings: DataFrame, column: str = "cell_ontology_id") -> DataFrame:
    """(term): distinct terms of cell types that mappings name by PURL."""
    return mappings.where(F.col(column).contains("CL")).select(F.regexp_replace(column, "^.*/", "").alias("term")).distinct()


def drug_names(targets: DataFrame) -> DataFrame:
    """(name): distinct names of drugs (drugs array<struct<name,withdrawn>>) that aren't withdrawn."""
    drug = targets.select(F.explode("drugs").alias("d"))
    return drug.where(~F.col("d.withdrawn") & F.col("d.name").isNotNull()).select("d.name").distinct()


def _clean(c: Column) -> Column:
    for old, new in CHARACTERS.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def annotation_term(role: str, mondo: Column) -> Column:
    """The term of the subject or object of an annotation ({role}_type, _name, _identifier; subject_identifier), or null."""
    kind, name, ident = F.col(f"{role}_type"), _clean(F.col(f"{role}_name")), F.replace(F.col(f"{role}_identifier"), F.lit("\u2212"), F.lit("-"))
    colon = lambda c: F.replace(c, F.lit(":"), F.lit("_"))
    owner = F.substring_index("subject_identifier", "-", 1)
    gene = name
    for old, new in GENE_NAMES.items():
        gene = F.replace(gene, F.lit(old), F.lit(new))
    doi = F.element_at(F.create_map(*[F.lit(x) for pair in PUBLICATIONS.items() for x in pair]), ident)
    return (
        F.when(kind.isin("Anatomical_structure", "Assay"), colon(ident))
        .when(kind == "Biomarker_combination", F.concat(F.lit("BMC_"), name, F.lit("-"), owner))
        .when(kind == "Cell_set", F.concat(F.lit("CS_"), terms.hyphenate(name), F.lit("-"), owner))
        .when(kind == "Cell_set_dataset", F.replace(ident, F.lit("NLP_dataset"), F.lit("CSD")))
        .when(kind == "Cell_type", colon(F.replace(ident, F.lit("<skos:related>"), F.lit(""))))
        .when(kind == "Disease", mondo)
        .when(kind == "Gene", F.when(gene == F.upper(gene), F.concat(F.lit("GS_"), gene)))
        .when(kind == "Publication", F.concat(F.lit("PUB_doi.org/"), doi))
    )


def annotation_tuples(annotations: DataFrame, mesh: DataFrame, predicates: DataFrame, source: str = "Manual Annotation") -> DataFrame:
    """Annotations to tuples: the relation, its source, and labels of cell sets.

    ``mesh`` is (mesh, mondo), ``predicates`` (relation, predicate); annotations with an end or relation that has no term
    make none.
    """
    rows = annotations.join(F.broadcast(predicates), "relation")
    for role in ("subject", "object"):
        table = mesh.select(F.col("mesh").alias(f"{role}_identifier"), terms.curie_to_term(F.col("mondo")).alias(f"{role}_mondo"))
        rows = rows.join(table, f"{role}_identifier", "left").withColumn(f"{role}_term", annotation_term(role, F.col(f"{role}_mondo")))
    s, o = (F.concat(F.lit(terms.PURL), f"{role}_term") for role in ("subject", "object"))
    p = F.concat(F.lit(terms.PURL), "predicate")
    label = lambda role: F.when(F.col(f"{role}_type") == "Cell_set", F.col(f"{role}_name"))
    tuples = [T.triple(s, p, o), T.quintuple(s, p, o, "Source", F.lit(source)), *T.annotations(s, {"Label": label("subject")}), *T.annotations(o, {"Label": label("object")})]
    return T.emit(rows.where("subject_term IS NOT NULL AND object_term IS NOT NULL"), tuples, "id")


def mapping_relations(mappings: DataFrame) -> DataFrame:
    """Mappings (cluster, cell_type, uberon, markers array, binary_genes array) to older relations: the cell type a part of
    the structure, genes a part of the cell type and selectively expressed by it."""
    good = mappings.where(F.col("cell_type").rlike(r"CL:\d{7}$"))
    cell_type = T.curie_term(F.col("cell_type"))
    once = T.association("CellTypePartOfAnatomicalStructure", cell_type, T.curie_term(F.col("uberon")), "Manual Mapping")
    gene = T.term("GS", F.col("gene"))
    each = T.association("GenePartOfCellType", gene, cell_type, "Manual Mapping") + T.association("CellTypeSelectivelyExpressesGene", cell_type, gene, "Manual Mapping")
    genes = good.withColumn("gene", F.explode(F.array_union("markers", "binary_genes")))
    return T.emit(good, once, "cluster").unionByName(T.emit(genes, each, "cluster", after=len(once)))


def instance_typing(clusters: DataFrame) -> DataFrame:
    """Clusters (cluster, uuid, markers array, binary_genes array): the type of their combination, and both gene lists as text."""
    combination = T.term("BMC", F.col("uuid"))
    tuples = [T.triple(combination, F.lit(f"{T.RDF}type"), F.lit(f"{terms.PURL}SO_0001260"))]
    tuples += T.annotations(combination, {"Markers": F.array_join("markers", " "), "Binary_genes": F.array_join("binary_genes", " ")})
    return T.emit(clusters, tuples, "cluster")


def drug_attributes(drugs: DataFrame) -> DataFrame:
    """Drugs (id, indications array, target, synonyms array, pubchem) to attributes as lists and a link."""
    listed = lambda c: F.when(F.size(c) > 0, F.array_join(c, ", "))
    fields = {"Indications": listed("indications"), "Target": F.col("target"), "Synonyms": listed("synonyms"), "Link_to_PubChem": F.concat(F.lit("pubchem.ncbi.nlm.nih.gov/compound/"), "pubchem")}
    return T.emit(drugs, T.annotations(T.term("CHEMBL", F.col("id")), fields), "id")


def field_dump(rows: DataFrame, prefix: str, key: str, fields: tuple[str, ...]) -> DataFrame:
    """The given fields of every row as annotations of ``PREFIX_key``, in the order of the list."""
    return T.emit(rows, T.annotations(T.term(prefix, F.col(key)), {c: F.col(c) for c in fields}), key)


def summarised(rows: DataFrame, key: str, qualifies: Column, arrays: tuple[str, ...], most: int = 3) -> DataFrame:
    """Sample mode: the first row by key that qualifies, its arrays cut to their first elements. The limit is the feature."""
    first = rows.where(qualifies).orderBy(key).limit(1)
    return first.withColumns({c: F.slice(c, 1, most) for c in arrays})


def entity_records(rows: DataFrame) -> DataFrame:
    """Entities of rows (cell_type, cell_type_name, uberon_purl, cluster, uuid, dataset, pmid, gene): a struct each, null where a key is missing."""
    pmid = F.when(F.col("pmid").cast("double") == F.floor(F.col("pmid").cast("double")), F.col("pmid").cast("double").cast("long"))
    some = lambda good, **fields: F.when(good, F.struct(*[c.alias(name) for name, c in fields.items()]))
    structure = F.replace(F.regexp_replace("uberon_purl", "^.*/", ""), F.lit("_"), F.lit(":"))
    return rows.select(
        some(F.col("cell_type").rlike(r"CL:\d{7}$"), id=F.col("cell_type"), name=F.col("cell_type_name")).alias("cell_type"),
        some(structure.startswith("UBERON:"), id=structure).alias("anatomical_structure"),
        some(F.col("cluster").isNotNull() & F.col("uuid").isNotNull(), id=T.entity_term("CellSet", name=F.col("cluster"), uuid=F.col("uuid"))).alias("cell_set"),
        some(F.col("dataset").isNotNull(), id=T.entity_term("CellSetDataset", id=F.col("dataset"))).alias("dataset"),
        some(pmid.isNotNull(), pmid=pmid).alias("publication"),
        some(F.col("gene").isNotNull(), id=T.entity_term("Gene", symbol=F.col("gene"))).alias("gene"),
    )


def dataset_tuples_by_pmid(mappings: DataFrame, clusters: DataFrame) -> DataFrame:
    """The older job over all datasets at once: mappings (dataset, pmid, cluster, cell_type, uberon) with clusters (dataset,
    cluster, uuid, markers, binary_genes): the relations of mappings, datasets' publications by number, and genes that cell types express."""
    rows = mappings.join(clusters, ["dataset", "cluster"])
    publication = T.association("CellSetDatasetWasAttributedToPublication", T.term("CSD", F.col("dataset")), T.term("PUB", F.col("pmid").cast("string")), "Manual Mapping")
    gene = rows.withColumn("gene", F.explode(F.array_union("markers", "binary_genes"))).where(F.col("cell_type").rlike(r"CL:\d{7}$"))
    expressed = T.association("CellTypeExpressesGene", T.curie_term(F.col("cell_type")), T.term("GS", F.col("gene")), "Manual Mapping")
    return mapping_relations(rows).unionByName(T.emit(rows, publication, "cluster")).unionByName(T.emit(gene, expressed, "cluster"))
