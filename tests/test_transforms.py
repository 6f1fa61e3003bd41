import base64
import gzip

from pyspark.sql import functions as F

from weftgraph.operators import datasets, lookups, transforms

GENE = """<Entrezgene><Entrezgene_type value="protein-coding"/><Entrezgene_source><BioSource><BioSource_org><Org-ref><Org-ref_taxname>Homo sapiens</Org-ref_taxname></Org-ref></BioSource_org></BioSource></Entrezgene_source>
<Entrezgene_gene><Gene-ref><Gene-ref_formal-name><Gene-nomenclature><Gene-nomenclature_symbol>ABC1</Gene-nomenclature_symbol><Gene-nomenclature_name>a gene</Gene-nomenclature_name></Gene-nomenclature></Gene-ref_formal-name>
<Gene-ref_syn><Gene-ref_syn_E>X1</Gene-ref_syn_E><Gene-ref_syn_E>X2</Gene-ref_syn_E></Gene-ref_syn></Gene-ref></Entrezgene_gene><Entrezgene_prot><Prot-ref><Prot-ref_desc>a protein</Prot-ref_desc></Prot-ref></Entrezgene_prot>
<c><Gene-commentary_heading>Reference: GCF_1.2</Gene-commentary_heading><Other-source_url>https://www.uniprot.org/P1.txt</Other-source_url></c>
<Gene-commentary_products><Gene-commentary><Gene-commentary_type value="mRNA"/><Gene-commentary_accession>NM_1</Gene-commentary_accession><Gene-commentary_accession>NP_2</Gene-commentary_accession></Gene-commentary></Gene-commentary_products></Entrezgene>"""


def variant(text):
    return F.try_parse_json(F.lit(text))


def test_gene(spark):
    packed = base64.b64encode(gzip.compress(GENE.encode())).decode()
    raw = spark.createDataFrame([("7", packed), ("8", "!!"), ("9", None)], "id string, x string").select("id", transforms.decoded(F.col("x")).alias("xml"))
    rows = {r.id: r for r in transforms.gene_fields(raw).collect()}
    gene = rows["7"]
    assert (gene.Official_symbol, gene.Gene_type, gene.Organism, gene.RefSeq_gene_ID, gene.Also_known_as, gene.UniProt_name) == ("ABC1", "protein-coding", "Homo sapiens", "GCF_1.2", ["X1", "X2"], "P1")
    assert gene["mRNA_(NM)_and_protein_(NP)_sequences"] == "NM_1 -> NP_2, a protein" and rows["8"].Official_symbol is None and rows["9"].Gene_type is None


def test_json_records(spark):
    one = spark.range(1).select(F.lit("d1").alias("id"), variant('{"title":"T","cell_count":5,"organism":[{"label":"h"},{"label":"m"}],"citation":"Publication: http://p Dataset Version: v Collection: http://c","assets":[{"url":"u"}]}').alias("dataset"), variant('{"name":"N","publisher_metadata":{"authors":[{"family":"A","given":"B"},{"family":"C"}],"published_year":2020,"journal":"J"}}').alias("collection"))
    row = transforms.dataset_fields(one).first()
    assert (row.Citation, row.Author_list, row.Year, row.Number_of_cells, row.Organism, row.Tissue) == ("A (2020) J", "A, B, C, ", "2020", 5, "h, m", "")
    assert (row.Link_to_publication, row.Link_to_CELLxGENE_collection, row.Link_to_CELLxGENE_dataset) == ("http://p", "http://c", "u")
    p = spark.range(1).select(F.lit("p").alias("id"), variant('{"primaryAccession":"P1","sequence":{"length":9},"genes":[{"geneName":{"value":"G"}}],"comments":[{"commentType":"FUNCTION","texts":[{"value":"a"}]},{"commentType":"X"},{"commentType":"FUNCTION","texts":[{"value":"b"},{"value":"c"}]}]}').alias("payload"))
    row = transforms.protein_fields(p).first()
    assert (row.UniProt_ID, row.Gene_name, row.Number_of_amino_acids, row.Function, row.Organism) == ("P1", "G", 9, "b", None)
    t = spark.range(1).select(F.lit("t").alias("id"), variant('{"target":{"id":"E"},"diseases":{"rows":[1,2]},"drugs":[3]}').alias("payload"))
    row = transforms.target_fields(t).select(F.to_json("diseases").alias("a"), F.to_json("drugs").alias("b"), "depmap").first()
    assert (row.a, row.b, row.depmap) == ("[1,2]", "[3]", None)
    c = spark.range(1).select(F.lit("c").alias("id"), variant('{"x":{"0":"a","1":"b"},"y":{"5":"q"}}').alias("payload"))
    assert {(r.field, r.value) for r in transforms.columnar_row(c).collect()} == {("x", "a"), ("y", "q")}


def test_companions_in_one_large_folder(spark):
    """A star in a result's own path is no pattern, a star in a role stays in its folder; a folder isn't joined with itself."""
    import time

    named = ("d/a*_results.csv", "d/ab_scores.csv", "d/a*_scores.csv", "d/a*_1_summary.csv", "d/a*__summary.csv", "d/a*_summary.csv", "d/a*_1/2_summary.csv")
    many = spark.range(60_000).select(F.concat(F.lit("d/"), F.col("id") % 30_000, F.when(F.col("id") < 30_000, "_results.csv").otherwise("_x_summary.csv")).alias("path"))
    files = spark.createDataFrame([(p,) for p in named], "path string").union(many)
    begun = time.monotonic()
    found = datasets.companions(files, "_results.csv$", {"scores": ("_results", "_scores"), "summary": ("_results", "_*_summary"), "two": ("_results", "*_*")}).collect()
    assert time.monotonic() - begun < 60
    got = {(r.path, r.role): r.companions for r in found}
    assert got["d/a*_results.csv", "scores"] == ["d/a*_scores.csv"]
    assert got["d/a*_results.csv", "summary"] == ["d/a*_1_summary.csv", "d/a*__summary.csv"]
    assert got["d/a*_results.csv", "two"] == ["d/a*_1_summary.csv", "d/a*__summary.csv", "d/a*_results.csv", "d/a*_scores.csv", "d/a*_summary.csv"]
    assert got["d/7_results.csv", "summary"] == ["d/7_x_summary.csv"] and len(found) == 1 + 30_001 + 30_001


def test_names_of_versions_without_one(spark):
    lists = spark.createDataFrame([(1, ["ENSG1.4", "ENSG1.2", "x"])], "k int, list array<string>")
    names = spark.createDataFrame([("ENSG1", "one")], "id string, name string")
    assert lookups.resolve_names(lists, "k", names, nameless=F.col("item").endswith(".4")).first()["names"] == ["ENSG1.4", "one", "x"]


def test_datasets(spark):
    files = spark.createDataFrame([(p,) for p in ("r/a/results/k_results.csv", "r/a/results/k_scores_1.csv", "r/a/results/k_scores_2.csv", "r/b/results/k_scores_3.csv")], "path string")
    found = datasets.companions(files, "_results", {"scores": ("_results", "_scores*")}).collect()
    assert [(r.path, r.companions) for r in found] == [("r/a/results/k_results.csv", ["r/a/results/k_scores_1.csv", "r/a/results/k_scores_2.csv"])]
    rows = spark.createDataFrame([("f", "a--b", None), ("g", None, "http://x/y/z.h5ad"), ("h", None, None)], "file string, dataset_version_id string, h5ad_url string")
    assert {r.file: r.ids for r in datasets.version_ids(rows).collect()} == {"f": ["a", "b"], "g": ["z"], "h": None}
    clusters = spark.createDataFrame([("c1", 12, "u1", "['A','B']", "['B','C']"), ("c2", 3, "u2", "['Z']", "[]")], "clusterName string, clusterSize long, uuid string, NSForest_markers string, binary_genes string")
    assert {r.gene for r in datasets.unique_genes(clusters).collect()} == {"A", "B", "C"}
    scores = spark.createDataFrame([("c1", 0.5)], "cell_type string, median double")
    assert datasets.with_scores(clusters, scores, "cell_type").count() == 1
    mapped = datasets.with_clusters(spark.createDataFrame([("c2", "old")], "author_cell_set string, uuid string"), clusters).first()
    assert (mapped.clusterSize, mapped.uuid) == (3, "u2")
    s = spark.createDataFrame([("1", None, None), ("2", "n", "u")], "id string, name string, url string")
    h = spark.createDataFrame([("1", "hn", "hu", "t"), ("3", "x", "y", "z")], "id string, name string, url string, tissue string")
    merged = {r.id: (r.name, r.url, r.tissue) for r in datasets.merged_dataset(s, h, "id", ("name",), ("url",), ("tissue",)).collect()}
    assert merged == {"1": (None, "hu", "t"), "2": ("n", "u", None), "3": ("x", "y", "z")}
    vertices, edges = datasets.schema_graph(spark.createDataFrame([("cell_type", "part_of", "organ")], "subject string, predicate string, object string"))
    assert {r.label for r in vertices.collect()} == {"Cell Type", "Organ"} and edges.count() == 1
