"""Rows to tuples: associations, annotations, and the writers of each source.

A writer turns rows into structs (s, p, o, attr, value) in one ``explode``; ``seq`` is the place of the tuple in its row's
list, on which last-wins rules depend. Tuples with a null term, object or value aren't emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions import terms
from weftgraph.functions.terms import PURL
from weftgraph.operators.sinks import write_ordered
from weftgraph.plans.iterate import step

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
MIN_CLUSTER_SIZE = 10
VALID_PHASES = ("PHASE_3", "APPROVAL")
# fixed values: attributes of a cell set from the scores of its cluster, with their columns
SILHOUETTE = {
    "silhouette_score": "median",
    "median_silhouette": "median",
    "mean_silhouette": "mean",
    "standard_deviation_of_silhouette": "std",
    "first_quartile_silhouette": "q1",
    "third_quartile_silhouette": "q3",
}
# fixed values: attributes of the edge from a cell set to its markers, by column
MARKER_EDGE = {"precision": "Precision", "TN": "TN", "TP": "TP", "FN": "FN", "FP": "FP", "marker_count": "Marker_count"}
# fixed values: associations and their predicates
PREDICATES = {
    "CellSetDatasetIsAboutAnatomicalStructure": "IAO_0000136",
    "CellSetDerivesFromAnatomicalStructure": "RO_0001000",
    "CellSetExpressesBinaryGeneSet": "RO_0002292",
    "CellSetExpressesGene": "RO_0002292",
    "CellSetHasCharacterizingMarkerSetBiomarkerCombination": "RO_0015004",
    "CellSetMemberOfCellSetDataset": "RO_0002350",
    "GenePartOfBiomarkerCombination": "BFO_0000050",
    "AnatomicalStructurePartOfAnatomicalStructure": "BFO_0000050",
    "BiomarkerCombinationSubclusterOfBinaryGeneSet": "RO_0015003",
    "CellSetComposedPrimarilyOfCellType": "RO_0002473",
    "CellTypeHasExemplarDataCellSetDataset": "RO_0015001",
    "CellSetDatasetWasAttributedToPublication": "source",
    "GeneIsGeneticBasisForDisease": "RO_0004010",
    "DrugMolecularlyInteractsWithProtein": "RO_0002436",
    "DrugIsSubstanceThatTreatsDisease": "RO_0002606",
    "DrugEvaluatedInClinicalTrial": "RO_0020325",
    "GeneHasQualityMutation": "RO_0000086",
    "MutationHasPharmacologicalEffectDrug": "RO_0002027",
    "MutationInvolvedInVariantConsequence": "RO_0002331",
    "GeneProducesProtein": "RO_0003000",
    "CellTypePartOfAnatomicalStructure": "BFO_0000050",
    "CellTypeExpressesGene": "RO_0002292",
    "GenePartOfCellType": "BFO_0000050",
    "CellTypeSelectivelyExpressesGene": "RO_0002294",
}
DC = "http://purl.org/dc/elements/1.1/"
# fixed values: fields of datasets, publications and proteins, by the column they come from
DATASET_FIELDS = {"Dataset_name": "dataset_name", "Organism": "species", "Tissue": "anatomical_structure", "Disease_status": "disease_status", "Number_of_cells": "cell_count", "Link_to_CELLxGENE_collection": "cellxgene_collection", "Link_to_CELLxGENE_dataset": "cellxgene_dataset", "Collection_ID": "collection_id"}
PUBLICATION_FIELDS = {"Author_list": "author_list", "Year": "year", "Title": "title", "Journal": "journal"}
PROTEIN_FIELDS = {"Protein_name": "label", "Number_of_amino_acids": "number_of_amino_acids", "Function": "protein_function", "Organism": "species", "Annotation_score": "annotation_score"}


def term(prefix: str, *parts: Column) -> Column:
    """``PURL/PREFIX_part-part``; null if a part is."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("-"), part)
    return F.concat(F.lit(f"{PURL}{prefix}_"), joined)


def curie_term(curie: Column) -> Column:
    return F.concat(F.lit(PURL), terms.curie_to_term(curie))


def predicate(association: str) -> Column:
    name = PREDICATES[association]
    return F.lit((DC if name == "source" else PURL) + name)


def catalogue(spark: SparkSession) -> DataFrame:
    """(association, predicate): all associations and the URI of their predicates."""
    return spark.createDataFrame([(name, (DC if p == "source" else PURL) + p) for name, p in PREDICATES.items()], "association string, predicate string")


def resolved(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (association, ...) with their predicate, and the rows whose association the catalogue lacks."""
    small = F.broadcast(known)  # the catalogue, of fixed size
    secure = F.regexp_replace("predicate", "^https:", "http:")
    return rows.join(small, "association").withColumn("predicate", secure), rows.join(small, "association", "left_anti")


def field_name(name: Column, names: dict[str, str] | None = None) -> Column:
    """The attribute of a field: as it is, but for the given names."""
    if not names:
        return name
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), name), name)


def entity_term(kind: str, **part: Column) -> Column:
    """The term of an entity of a kind from its parts; null if a part that its rule needs is missing."""
    by = {
        "Gene": lambda: F.concat(F.lit("GS_"), part["symbol"]),
        "Protein": lambda: F.concat(F.lit("PR_"), part["accession"]),
        "CellSet": lambda: F.concat(F.lit("CS_"), terms.hyphenate(part["name"]), F.lit("-"), part["uuid"]),
        "CellSetDataset": lambda: F.concat(F.lit("CSD_"), part["id"]),
        "BiomarkerCombination": lambda: F.concat(F.lit("BMC_"), part["uuid"]),
        "BinaryGeneSet": lambda: F.concat(F.lit("BGS_"), part["uuid"]),
        "Publication": lambda: F.concat(F.lit("PUB_"), F.coalesce(part["dataset"], part["doi"])),
        "Drug": lambda: F.coalesce(F.concat(F.lit("CHEMBL_"), F.replace(part["id"], F.lit("CHEMBL"), F.lit(""))), F.concat(F.lit("DRUG_"), part["label"])),
        "ClinicalTrial": lambda: F.concat(F.lit("NCT_"), F.regexp_replace(F.upper(part["id"]), "^NCT_?", "")),
        "Mutation": lambda: F.replace(part["id"], F.lit("rs"), F.lit("RS_")),
    }
    return by[kind]() if kind in by else terms.curie_to_term(part["curie"])


def triple(s: Column, p: Column, o: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(s.alias("s"), p.alias("p"), o.cast("string").alias("o"), none.alias("attr"), none.alias("value"))


def quintuple(s: Column, p: Column, o: Column, attr: str, value: Column) -> Column:
    return F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit(f"{RDF}{attr}").alias("attr"), value.cast("string").alias("value"))


def annotations(subject: Column, fields: dict[str, Column]) -> list[Column]:
    """One literal triple for each field."""
    return [triple(subject, F.lit(f"{RDF}{name}"), terms.without_protocols(value.cast("string"))) for name, value in fields.items()]


def association(name: str, s: Column, o: Column, source: str | None = None, fields: dict[str, Column] | None = None) -> list[Column]:
    """The relation, its source, and the attributes of the edge."""
    out = [triple(s, predicate(name), o)]
    if source is not None:
        out.append(quintuple(s, predicate(name), o, "Source", F.lit(source)))
    return out + [quintuple(s, predicate(name), o, attr, value) for attr, value in (fields or {}).items()]


def emit(rows: DataFrame, tuples: list[Column], *keys: str, after: int = 0) -> DataFrame:
    """(keys, seq, arity, s, p, o, attr, value) of all tuples of all rows; places are counted from ``after``."""
    whole = lambda x: x["s"].isNotNull() & x["p"].isNotNull() & x["o"].isNotNull() & (x["attr"].isNull() | x["value"].isNotNull())
    made = rows.select(*keys, F.posexplode(F.array(*tuples)).alias("seq", "t")).where(whole(F.col("t"))).withColumn("seq", F.col("seq") + after)
    arity = F.when(F.col("t.attr").isNull(), 3).otherwise(5)
    return made.select(*keys, "seq", arity.alias("arity"), "t.*")


def marker_tuples(clusters: DataFrame) -> DataFrame:
    """Clusters (cluster, size, uuid, f_score, markers array, dataset, uberon) of enough cells to tuples.

    Columns that may be absent: binary_genes array (genes of the binary gene set, which are then those expressed, instead of
    the markers), citation (of the dataset), the columns of ``MARKER_EDGE`` and of ``SILHOUETTE``; ``about`` (boolean) asks for what
    datasets are about.
    """
    big = clusters.where(F.col("size") >= MIN_CLUSTER_SIZE)
    cell_set, combination = term("CS", F.col("cluster"), F.col("uuid")), term("BMC", F.col("uuid"))
    dataset = term("CSD", F.col("dataset"))
    once = [
        *annotations(cell_set, {"Author_cell_set": F.col("cluster"), "Total_cell_count": F.col("size")}),
        *association("CellSetDerivesFromAnatomicalStructure", cell_set, curie_term(F.col("uberon")), "NSForest"),
        *association("CellSetHasCharacterizingMarkerSetBiomarkerCombination", cell_set, combination, "NSForest", {"F_beta_confidence_score": F.col("f_score")}),
        *association("CellSetMemberOfCellSetDataset", cell_set, dataset, "NSForest"),
    ]
    has = set(clusters.columns)
    once += annotations(cell_set, {attr: F.col(c) for attr, c in SILHOUETTE.items() if c in has})
    edge = {attr: F.col(c) for c, attr in MARKER_EDGE.items() if c in has}
    if edge:
        marked = predicate("CellSetHasCharacterizingMarkerSetBiomarkerCombination")
        edge_tuples = [quintuple(cell_set, marked, combination, attr, value) for attr, value in edge.items()]
        once += [*edge_tuples, quintuple(cell_set, marked, combination, "source_algorithm", F.lit("NSForest-v4.0_dev"))]
    if "about" in has:
        anatomy = F.when(F.col("about"), curie_term(F.col("uberon")))
        once += association("CellSetDatasetIsAboutAnatomicalStructure", dataset, anatomy, "NSForest")
    if "citation" in has:
        once += annotations(dataset, {"Citation": F.col("citation")})
    gene = term("GS", F.col("gene"))
    part = association("GenePartOfBiomarkerCombination", gene, combination, "NSForest")
    expressed = association("CellSetExpressesGene", cell_set, gene, "NSForest")
    genes = big.withColumn("gene", F.explode("markers"))
    if "binary_genes" not in has:
        return emit(big, once, "cluster").unionByName(emit(genes, part + expressed, "cluster", after=len(once)))
    binary = term("BGS", F.col("uuid"))
    once += association("CellSetExpressesBinaryGeneSet", cell_set, binary, "NSForest")
    once += association("BiomarkerCombinationSubclusterOfBinaryGeneSet", combination, binary, "NSForest")
    binary_genes = big.withColumn("gene", F.explode("binary_genes"))
    made = emit(big, once, "cluster").unionByName(emit(genes, part, "cluster", after=len(once)))
    return made.unionByName(emit(binary_genes, expressed, "cluster", after=len(once) + len(part)))


def mapping_tuples(mappings: DataFrame) -> DataFrame:
    """Mappings (cluster, uuid, cell_type, match, method, dataset, label) with a valid cell type to tuples."""
    good = mappings.where(F.col("cell_type").rlike(r"CL:\d{7}$"))
    cell_set, cell_type, dataset = term("CS", F.col("cluster"), F.col("uuid")), curie_term(F.col("cell_type")), term("CSD", F.col("dataset"))
    tuples = [
        *annotations(cell_type, {"Name": F.col("label")}),
        *association("CellSetComposedPrimarilyOfCellType", cell_set, cell_type, "Manual Mapping", {"Match": F.col("match"), "Mapping_method": F.col("method")}),
        *association("CellTypeHasExemplarDataCellSetDataset", cell_type, dataset, "Manual Mapping"),
    ]
    if "citation" in mappings.columns:
        tuples += annotations(dataset, {"Citation": F.col("citation")})
    return emit(good, tuples, "cluster")


def dataset_tuples(datasets: DataFrame) -> DataFrame:
    """Datasets (id, Link_to_publication, Citation and the columns of the field lists) to tuples of datasets and publications."""
    dataset, publication = term("CSD", F.col("id")), term("PUB", F.col("id"))
    link = {"publication_doi": F.col("Link_to_publication")}
    fields = lambda names: {name: F.col(c) for c, name in names.items()}
    tuples = [
        *association("CellSetDatasetWasAttributedToPublication", dataset, publication, "CELLxGENE"),
        *annotations(dataset, fields(DATASET_FIELDS)),
        *annotations(publication, link | fields(PUBLICATION_FIELDS)),
        *annotations(dataset, {"Citation": F.nullif("Citation", F.lit(""))}),
        *annotations(publication, {"Citation": F.nullif("Citation", F.lit(""))}),
    ]
    return emit(datasets, tuples, "id")


def protein_tuples(proteins: DataFrame) -> DataFrame:
    """Proteins (accession and the columns of the field list) to annotations."""
    return emit(proteins, annotations(term("PR", F.col("accession")), {name: F.col(c) for c, name in PROTEIN_FIELDS.items()}), "accession")


def in_order(*writers: DataFrame) -> DataFrame:
    """The tuples of all writers, each with the place of its writer in ``file_rank``: later ones take precedence."""
    columns = ["seq", "arity", "s", "p", "o", "attr", "value"]
    first, *rest = [tuples.select(F.lit(rank).alias("file_rank"), *columns) for rank, tuples in enumerate(writers)]
    for tuples in rest:
        first = first.unionByName(tuples)
    return first


#: Tuples of which one task removes repeats, about; tasks at most, as Spark deals rows to so many without holding them in memory.
TUPLES_OF_TASK, MOST_TASKS = 100_000, 200


def deduplicated(tuples: DataFrame, tasks: int | None = None) -> DataFrame:
    """Tuples without repeats: relations and their attributes once, of a subject's annotations (s, p) the last (file_rank, seq).

    With ``tasks``, tuples are dealt to so many before repeats are looked for: else a task sorts all that its file makes.
    """
    order = F.struct("file_rank", "seq", "o", "value")
    annotation = F.col("p").startswith(RDF) & (F.col("arity") == 3)
    key = F.when(annotation, F.lit("")).otherwise(F.concat_ws("\u0001", "o", "attr", F.coalesce("value", F.lit(""))))
    keyed = tuples.withColumn("_key", key)
    if tasks is not None:
        keyed = keyed.repartition(tasks, "s", "p", "_key")
    last = keyed.groupBy("arity", "s", "p", "_key").agg(F.max_by(F.struct("file_rank", "seq", "o", "attr", "value"), order).alias("x"))
    return last.select("x.file_rank", "x.seq", "arity", "s", "p", "x.o", "x.attr", "x.value")


def pipeline(writers: list[DataFrame], path: str, per_file: int = 1_000_000) -> DataFrame:
    """Runs all writers in their order, later ones taking precedence, and writes what remains as ordered tuple files.

    Returns the tuples as they were written: (file_rank, seq, arity, s, p, o, attr, value).
    """
    tuples = in_order(*writers)
    made = step(deduplicated(tuples, min(tuples.count() // TUPLES_OF_TASK + 1, MOST_TASKS)))
    write_ordered(made, path, per_file)
    return made


def target_tuples(targets: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Targets (gene, protein, diseases array<struct<id,name,score>>, drugs array<struct<id,name,phase,withdrawn,trials array<string>>>) to tuples.

    What may be absent: ``indications`` array<struct<id,name,stage,trials array<string>>> and ``warnings`` array<string> in a drug -
    one of these that says Withdrawn leaves the drug out, as does ``withdrawn`` - and a column
    ``pharmacogenetics`` array<struct<rs,consequence,consequence_label,drugs array<struct<id,name>>>>.
    """
    gene = term("GS", F.col("gene"))
    disease = targets.withColumn("d", F.explode("diseases")).where(F.col("d.score") >= least_score)
    of_disease = term("MONDO", F.col("d.id"))
    diseases = emit(disease, [*annotations(of_disease, {"Name": F.col("d.name")}), *association("GeneIsGeneticBasisForDisease", gene, of_disease, "Open Targets", {"Score": F.col("d.score")})], "gene")
    drug = targets.withColumn("d", F.explode("drugs")).where(F.col("d.phase").isin(*VALID_PHASES) & ~F.col("d.withdrawn"))
    if "warnings" in targets.schema["drugs"].dataType.elementType.names:
        drug = drug.where(~F.coalesce(F.array_contains("d.warnings", "Withdrawn"), F.lit(False)))
    of_drug = term("CHEMBL", F.col("d.id"))
    drugs = emit(drug, [*annotations(of_drug, {"Name": F.col("d.name")}), *association("DrugMolecularlyInteractsWithProtein", of_drug, term("PR", F.col("protein")), "Open Targets")], "gene")
    trial = drug.withColumn("trial", F.explode("d.trials")).where(F.lower("trial").contains("nct"))
    trials = emit(trial, association("DrugEvaluatedInClinicalTrial", of_drug, term("NCT", F.regexp_replace(F.upper("trial"), "^NCT_?", "")), "Open Targets"), "gene")
    out = diseases.unionByName(drugs).unionByName(trials)
    if "indications" in targets.schema["drugs"].dataType.elementType.names:
        treated = drug.withColumn("i", F.explode("d.indications")).where(F.col("i.stage").isin(*VALID_PHASES) & F.col("i.id").isNotNull())
        of_treated = term("MONDO", F.col("i.id"))
        treats = [*annotations(of_treated, {"Name": F.col("i.name")}), *association("DrugIsSubstanceThatTreatsDisease", of_drug, of_treated, "Open Targets")]
        report = treated.withColumn("trial", F.explode("i.trials")).where(F.lower("trial").contains("nct"))
        of_trial = term("NCT", F.regexp_replace(F.upper("trial"), "^NCT_?", ""))
        out = out.unionByName(emit(treated, treats, "gene")).unionByName(emit(report, association("DrugEvaluatedInClinicalTrial", of_drug, of_trial, "Open Targets"), "gene"))
    if "pharmacogenetics" in targets.columns:
        found = targets.withColumn("m", F.explode("pharmacogenetics")).where(F.col("m.rs").isNotNull())
        mutation = F.concat(F.lit(PURL), F.replace(F.col("m.rs"), F.lit("rs"), F.lit("RS_")))
        consequence = F.concat(F.lit(PURL), F.when(F.col("m.consequence") != "", F.col("m.consequence")))
        label = F.when(consequence.isNotNull() & (F.col("m.consequence_label") != ""), F.col("m.consequence_label"))
        mutations = [
            *association("GeneHasQualityMutation", gene, mutation, "Open Targets"),
            *association("MutationInvolvedInVariantConsequence", mutation, consequence, "Open Targets"),
            *annotations(consequence, {"Variant_consequence_label": label}),
        ]
        affected = found.withColumn("d", F.explode("m.drugs")).where(F.col("d.id").isNotNull())
        of_affected = term("CHEMBL", F.replace(F.col("d.id"), F.lit("CHEMBL"), F.lit("")))
        name = F.coalesce(F.col("d.name"), F.col("d.id"))
        effects = [*annotations(of_affected, {"Name": name}), *association("MutationHasPharmacologicalEffectDrug", mutation, of_affected, "Open Targets")]
        out = out.unionByName(emit(found, mutations, "gene")).unionByName(emit(affected, effects, "gene"))
    return out


def gene_tuples(genes: DataFrame) -> DataFrame:
    """Genes (symbol, protein, fields) to tuples: produced protein if there is one, and annotations."""
    gene = term("GS", F.col("symbol"))
    fields = {c: F.col(c) for c in genes.columns if c not in ("symbol", "protein")}
    return emit(genes, [*association("GeneProducesProtein", gene, term("PR", F.col("protein")), "UniProt"), *annotations(gene, fields)], "symbol")


def part_of_tuples(structures: DataFrame) -> DataFrame:
    """Anatomical structures (id, label, part_of array) of one ontology to part-of tuples."""
    each = structures.withColumn("whole", F.explode("part_of")).where(F.col("id").contains("UBERON") & F.col("whole").contains("UBERON"))
    s = curie_term(F.col("id"))
    return emit(each, [*annotations(s, {"Label": F.col("label")}), *association("AnatomicalStructurePartOfAnatomicalStructure", s, curie_term(F.col("whole")), "HuBMAP")], "id")


def cell_type_part_of_tuples(cell_types: DataFrame, known: DataFrame) -> DataFrame:
    """Cell types (id, located_in array) that mappings know (id), to part-of tuples; ids of other ontologies are left out."""
    each = cell_types.join(known.select("id").distinct(), "id", "left_semi").withColumn("whole", F.explode("located_in"))
    each = each.where(F.col("id").startswith("CL:") & F.col("whole").contains("UBERON"))
    return emit(each, association("AnatomicalStructurePartOfAnatomicalStructure", curie_term(F.col("id")), curie_term(F.col("whole")), "HuBMAP"), "id")


def publication_record(tuples: DataFrame, fields: tuple[str, ...] = ("Author", "Title", "Year", "Journal")) -> DataFrame:
    """(s, fields): of each subject the last value of each annotation named so."""
    field = F.substring_index("p", "#", -1)
    each = tuples.withColumn("field", field).where(F.col("field").isin(*fields))
    return each.groupBy("s").pivot("field", list(fields)).agg(F.max_by("o", "seq"))


def realised(rows: DataFrame, required: dict[str, Column]) -> DataFrame:
    """Adds ``status``: Created, or Partial or Failed where some or all of the required fields are missing."""
    missing = sum((c.isNull().cast("int") for c in required.values()), F.lit(0))
    return rows.withColumn("status", F.when(missing == 0, "Created").when(missing < len(required), "Partial").otherwise("Failed"))
