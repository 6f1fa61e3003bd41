"""Tuple writers with every optional column, against tuples by hand."""

from weftgraph.functions.terms import PURL
from weftgraph.operators import writers as T


def short(frame):
    """(s, predicate, o, attribute, value) without the common prefixes."""
    cut = lambda x: x and x.replace(PURL, "").replace(T.RDF, "#")
    return {tuple(cut(x) for x in (r.s, r.p, r.o, r.attr, r.value)) for r in frame.collect()}


def links(found):
    return {x[:3] for x in found if x[3] is None and not x[1].startswith("#")}


def test_targets_with_indications_and_mutations(spark):
    drugs = "array<struct<id string,name string,phase string,withdrawn boolean,trials array<string>,indications array<struct<id string,name string,stage string,trials array<string>>>>>"
    mutations = "array<struct<rs string,consequence string,consequence_label string,drugs array<struct<id string,name string>>>>"
    schema = f"gene string, protein string, diseases array<struct<id string,name string,score double>>, drugs {drugs}, pharmacogenetics {mutations}"
    treated = [("5", "flu", "APPROVAL", ["NCT01", "x"]), ("6", "cold", "PHASE_1", ["NCT02"]), (None, "none", "APPROVAL", ["NCT03"])]
    variants = [("rs7", "SO_1", "missense", [("CHEMBL9", None), (None, "y")]), ("rs8", None, "lost", None), (None, "SO_2", "z", [("CHEMBL1", "q")])]
    rows = [("A", "P1", [], [("3", "drug", "APPROVAL", False, None, treated), ("4", "old", "APPROVAL", True, None, treated)], variants), ("B", "P2", None, None, None)]
    found = short(T.target_tuples(spark.createDataFrame(rows, schema)))
    assert links(found) == {
        ("CHEMBL_3", "RO_0002436", "PR_P1"),
        ("CHEMBL_3", "RO_0002606", "MONDO_5"),
        ("CHEMBL_3", "RO_0020325", "NCT_01"),
        ("GS_A", "RO_0000086", "RS_7"),
        ("GS_A", "RO_0000086", "RS_8"),
        ("RS_7", "RO_0002331", "SO_1"),
        ("RS_7", "RO_0002027", "CHEMBL_9"),
    }
    assert ("SO_1", "#Variant_consequence_label", "missense", None, None) in found
    assert ("MONDO_5", "#Name", "flu", None, None) in found and ("CHEMBL_9", "#Name", "CHEMBL9", None, None) in found


def test_markers_with_binary_genes(spark):
    schema = "cluster string, size int, uuid string, f_score double, markers array<string>, dataset string, uberon string, binary_genes array<string>, citation string, about boolean, precision double, TN int, TP int, FN int, FP int, marker_count int"
    rows = [("c", 10, "u", 0.5, ["G1"], "d", "UBERON:1", ["G1", "G2"], "cited", True, 0.9, 1, 2, 3, 4, 1), ("small", 9, "v", 0.5, ["G1"], "d", "UBERON:1", ["G1"], "cited", True, 0.9, 1, 2, 3, 4, 1)]
    found = short(T.marker_tuples(spark.createDataFrame(rows, schema)))
    assert links(found) == {
        ("CSD_d", "IAO_0000136", "UBERON_1"),
        ("CS_c-u", "RO_0001000", "UBERON_1"),
        ("CS_c-u", "RO_0002292", "BGS_u"),
        ("CS_c-u", "RO_0002292", "GS_G1"),
        ("CS_c-u", "RO_0002292", "GS_G2"),
        ("CS_c-u", "RO_0015004", "BMC_u"),
        ("CS_c-u", "RO_0002350", "CSD_d"),
        ("GS_G1", "BFO_0000050", "BMC_u"),
        ("BMC_u", "RO_0015003", "BGS_u"),
    }
    edge = {(x[3], x[4]) for x in found if x[:3] == ("CS_c-u", "RO_0015004", "BMC_u") and x[3]}
    assert edge == {("#Source", "NSForest"), ("#F_beta_confidence_score", "0.5"), ("#source_algorithm", "NSForest-v4.0_dev"), ("#Precision", "0.9"), ("#TN", "1"), ("#TP", "2"), ("#FN", "3"), ("#FP", "4"), ("#Marker_count", "1")}
    assert ("CSD_d", "#Citation", "cited", None, None) in found
