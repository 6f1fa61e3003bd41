"""Work that is dealt over tasks by a count of rows, parsed once, or joined without being made distinct."""

from conftest import TINY

from weftgraph.operators import reports
from weftgraph.operators import writers as T
from weftgraph.plans import graph_queries, source_queries


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_classes_are_parsed_once(spark, monkeypatch):
    monkeypatch.setattr(source_queries, "CLASSES_OF_TASK", 10, raising=False)
    assert "from_xml" not in plan(source_queries.xml_classes(spark, TINY))


def test_tuples_are_dealt_before_repeats_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(T, "TUPLES_OF_TASK", 10, raising=False)
    genes = spark.createDataFrame([(str(i % 50), str(i), "x") for i in range(200)], "symbol string, protein string, Name string")
    made = T.pipeline([T.gene_tuples(genes)], str(tmp_path / "t"))
    assert made.count() == 450 and len(made.inputFiles()) > 10


def test_edges_of_attributes_are_not_made_distinct(spark):
    assert plan(graph_queries.quintuples_without_edge(spark, TINY)).count("Aggregate") == 0
    assert plan(graph_queries.edge_attributes_last_wins(spark, TINY)).count("Aggregate") == 1


def test_payloads_are_dealt_over_tasks(spark, monkeypatch):
    seen, step = [], reports.step
    monkeypatch.setattr(reports, "PAYLOADS_OF_TASK", 5, raising=False)
    monkeypatch.setattr(reports, "step", lambda frame: seen.append(plan(frame)) or step(frame))
    rows = spark.sql("SELECT id AS key, parse_json('{\"a\": [1, 1]}') AS v FROM range(20)").coalesce(1)
    assert reports.leaves(rows, "key", "v").count() == 40
    assert "RepartitionByExpression" in seen[0]
