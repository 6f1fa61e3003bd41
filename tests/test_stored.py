"""Structures that are written and read back, on small tables: streamed graphs, ordered files, slims, indexes, alternatives."""

import random

from pyspark.sql import functions as F

from weftgraph.operators import associations as A
from weftgraph.operators import search_index, sinks, slims
from weftgraph.operators import writers as T
from weftgraph.sources import files
from weftgraph.streaming import edges as stream

P = "http://purl.obolibrary.org/obo/"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
VALID = ("A", "B")


def link(rank, seq, a, b, label="x"):
    return (rank, seq, P + a, f"http://x.org/p#{label}", P + b)


def name(rank, seq, a):
    return (rank, seq, P + a, RDFS + "label", "name")


def graph(spark, folder):
    settled = {(r["src"], r["dst"], r["label"]) for r in stream.kept(spark, folder, "edges").collect()}
    waiting = {(r["src"], r["dst"], r["missing"], r["want"]) for r in stream.kept(spark, folder, "waiting").collect()}
    return settled, waiting, {r["id"] for r in stream.kept(spark, folder, "vertices").collect()}


def test_links_wait_for_their_ends(spark, tmp_path):
    out, frame = str(tmp_path), lambda rows: spark.createDataFrame(rows, stream.TUPLES)
    batches = [
        [link(0, 1, "A_1", "B_1"), link(0, 2, "A_2", "B_9"), name(0, 3, "B_1"), link(0, 4, "C_1", "B_1"), (0, 5, P + "A_1", "http://x.org/RO_9", P + "B_1")],
        [],
        [name(1, 1, "A_1"), name(1, 2, "A_2"), link(1, 3, "A_1", "B_1")],
        [name(2, 1, "B_9"), link(2, 2, "B_9", "A_1"), link(2, 3, "A_3", "A_1")],
    ]
    for number, rows in enumerate(batches):
        stream.fold(frame(rows), out, number, VALID)
        if number == 0:
            assert graph(spark, out) == (set(), {("A/1", "B/1", "A/1", "src"), ("A/2", "B/9", "A/2", "src")}, {"B/1"})
        if number == 2:
            assert graph(spark, out)[:2] == ({("A/1", "B/1", "X")}, {("A/2", "B/9", "B/9", "dst")})
            stream.fold(frame(rows), out, number, VALID)  # as after a failure
    assert graph(spark, out) == ({("A/1", "B/1", "X"), ("A/2", "B/9", "X"), ("B/9", "A/1", "X")}, {("A/3", "A/1", "A/3", "src")}, {"A/1", "A/2", "B/1", "B/9"})


def test_files_in_any_order_give_one_graph(spark, tmp_path):
    rng = random.Random(2)
    ids = [f"{rng.choice('AB')}_{i}" for i in range(12)]
    rows = [link(0, i, rng.choice(ids), rng.choice(ids), rng.choice(("x", "y"))) for i in range(40)] + [name(0, 100 + i, x) for i, x in enumerate(ids[:9])]
    rng.shuffle(rows)
    for k in range(3):
        stream.fold(spark.createDataFrame(rows[k::3], stream.TUPLES), str(tmp_path), k, VALID)
    known = {x.replace("_", "/") for x in ids[:9]}
    ends = {(s.removeprefix(P).replace("_", "/"), o.removeprefix(P).replace("_", "/"), p[-1].upper()) for _, _, s, p, o in rows if o.startswith("http")}
    settled, waiting, _ = graph(spark, str(tmp_path))
    assert settled == {e for e in ends if {e[0], e[1]} <= known}
    assert {(a, b) for a, b, *_ in waiting} == {(a, b) for a, b, _ in ends if not {a, b} <= known}


def test_ordered_tuples_are_read_in_the_order_they_had(spark, tmp_path):
    none = None
    rows = [(i % 3, i, f"s{i}", "p", 'o"\\', none if i % 4 else "a", none if i % 4 else f"v{i}") for i in range(500)]
    random.Random(1).shuffle(rows)
    tuples = spark.createDataFrame(rows, "file_rank int, seq long, s string, p string, o string, attr string, value string").repartition(7)
    sinks.write_ordered(tuples, str(tmp_path / "t"), per_file=40)
    back = files.ordered_tuples(spark, str(tmp_path / "t")).orderBy("file", "position").collect()
    assert [(r["s"], r["o"], r["attr"], r["value"]) for r in back] == [(s, o, a, v) for _, _, s, _, o, a, v in sorted(rows, key=lambda r: r[:2])]
    assert {r["arity"] for r in back} == {3, 5}
    lines = [len(x.read_text().splitlines()) for x in (tmp_path / "t").glob("part-*")]
    assert max(lines) <= 40 and sum(lines) == 500
    sinks.write_ordered(tuples.limit(0), str(tmp_path / "e"))
    assert files.ordered_tuples(spark, str(tmp_path / "e")).count() == 0


def test_a_batch_of_several_files(spark, tmp_path):
    rows = [name(0, 1, "A_1"), link(1, 2, "A_1", "B_1"), name(0, 3, "B_1"), link(1, 4, "B_1", "A_9")]
    for row in rows:
        spark.createDataFrame([row], stream.TUPLES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), VALID, None, 2).awaitTermination()
    assert len(list((tmp_path / "out" / "waiting").glob("batch=*"))) == 2
    assert [(r["src"], r["dst"]) for r in stream.kept(spark, str(tmp_path / "out"), "edges").collect()] == [("A/1", "B/1")]
    assert {r["dst"] for r in stream.kept(spark, str(tmp_path / "out"), "waiting").collect()} == {"A/9"}


def test_settled_edges_are_written_once(spark, tmp_path):
    names = [name(0, i, f"A_{i}") for i in range(20)]
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    for k in range(3):  # all ends are known, so that each batch settles its links, one of them again
        rows = [link(1, 100 * k + i, f"A_{i}", f"A_{(i + k) % 20}", f"p{k}") for i in range(20)] + [link(1, 50, "A_0", "A_0", "p0")]
        stream.fold(spark.createDataFrame(names + rows, stream.TUPLES), str(tmp_path), k, VALID)
        stored = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "edges")).count()
        assert stored == 21 * (k + 1)
    assert stream.kept(spark, str(tmp_path), "edges").count() == 60
    assert {p.name for p in (tmp_path / "edges").glob("batch=*/state=*")} == {"state=settled"}
    assert spark.conf.get("spark.sql.parquet.compression.codec") == before


def test_folders_of_settled_edges_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "FOLDERS", 2)
    one = P + "RO_1"
    for k in range(5):
        rows = [name(0, 1, "A_1"), name(0, 2, "B_1"), name(0, 3, f"A_{k}"), link(k, 5, f"A_{k}", "B_1"), (9 if k == 3 else k, 6, P + "A_1", one, P + "B_1")]
        labels = spark.createDataFrame([("RO_1", f"label {k}")], "term string, label string")
        for _ in range(1 + (k == 2)):  # and twice, as after a failure
            stream.fold(spark.createDataFrame(rows, stream.TUPLES), str(tmp_path), k, VALID, labels)
        found = sorted((r["src"], r["key"], r["label"]) for r in stream.kept(spark, str(tmp_path), "edges").collect())
        assert found == sorted([(f"A/{i}", f"{i}-p:x-1", "X") for i in range(k + 1)] + [("A/1", "1-RO:1-1", f"LABEL_{3 if k > 2 else k}")])
        assert len(stream._settled(spark, str(tmp_path))) <= 2
    # what batches before the last one have replaced is gone
    assert [p.parent.name for p in sorted((tmp_path / "edges").glob("batch=*/state=*"))] == ["batch=2", "batch=3", "batch=4"]
    assert "batch=0" not in {p.parent.name for p in (tmp_path / "vertices").glob("batch=*/bucket=*") if p.name == f"bucket={stream._buckets(spark.createDataFrame([('A/1',)], 'id string'), 'id').pop()}"}


def test_texts_are_spread_before_tokens_are_made(spark, monkeypatch):
    from weftgraph.operators import search

    monkeypatch.setattr(search, "CHARACTERS", 100)
    fields = spark.range(50).select(F.lit("C").alias("collection"), F.col("id").cast("string").alias("key"), F.lit("f").alias("field"), F.lit("red fox ran").alias("text")).coalesce(1)
    assert search._spread(fields).rdd.getNumPartitions() == 6 and search._spread(fields.limit(0)).rdd.getNumPartitions() == 1
    for make, tokens in ((search.char_ngrams, 9 + 8 + 1), (search.word_prefixes, 3)):
        assert make(fields).count() == 50 * tokens
        assert make(fields)._jdf.queryExecution().executedPlan().toString().count("ENSURE_REQUIREMENTS") == 0


def test_order_of_more_files_than_three_digits_count(spark, tmp_path):
    rows = spark.range(1200).select(F.lit(0).alias("file_rank"), F.col("id").alias("seq"), F.col("id").cast("string").alias("s"), *[F.lit(None).cast("string").alias(c) for c in ("p", "o", "attr", "value")])
    sinks.write_ordered(rows, str(tmp_path / "t"), per_file=1)
    back = files.ordered_tuples(spark, str(tmp_path / "t")).orderBy("file", "position").collect()
    assert [int(r["s"]) for r in back] == list(range(1200))


def test_writers_in_order_leave_the_last_annotation(spark, tmp_path):
    writer = lambda label: T.part_of_tuples(spark.createDataFrame([("UBERON:1", label, ["UBERON:2"])], "id string, label string, part_of array<string>"))
    made = T.pipeline([writer("first"), writer("second")], str(tmp_path / "t"))
    assert [r["o"] for r in made.where(f"p LIKE '%Label'").collect()] == ["second"]
    assert files.ordered_tuples(spark, str(tmp_path / "t")).count() == 3  # relation, source and label, once each


ONTOLOGY = f"""<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s">
  <owl:Ontology rdf:about="{P}x.owl"/>
  <owl:ObjectProperty rdf:about="{P}RO_1"/>
  <owl:Axiom><owl:annotatedSource rdf:resource="{P}early"/></owl:Axiom>
  <owl:Class rdf:about="{P}X_1"><owl:equivalentClass><owl:Class><rdfs:label>inner</rdfs:label></owl:Class></owl:equivalentClass>
    <rdfs:subClassOf><owl:Restriction><owl:someValuesFrom rdf:resource="{P}NCBITaxon_9606"/></owl:Restriction></rdfs:subClassOf></owl:Class>
  <owl:Axiom><owl:annotatedTarget><owl:Class rdf:about="{P}X_1"/></owl:annotatedTarget><owl:x/></owl:Axiom>
  <owl:Class rdf:about="{P}X_2"/>
  <owl:Class rdf:about="{P}X_3"><rdfs:subClassOf><owl:Restriction><owl:someValuesFrom rdf:resource="{P}NCBITaxon_96061"/></owl:Restriction></rdfs:subClassOf></owl:Class>
  <owl:Class><rdfs:label>no name</rdfs:label></owl:Class>
  <owl:NamedIndividual rdf:about="{P}I_1"/>
  <owl:Class rdf:about="{P}X_4"><owl:unionOf><owl:Class rdf:about="{P}X_5"><owl:someValuesFrom
     rdf:resource="{P}NCBITaxon_9606"/></owl:Class></owl:unionOf></owl:Class>
  <owl:Axiom><owl:annotatedTarget><owl:Class rdf:about="{P}X_6"><rdfs:label>a</rdfs:label></owl:Class></owl:annotatedTarget></owl:Axiom>
</rdf:RDF>
"""


def test_slim_keeps_what_it_should(spark, tmp_path):
    import xml.etree.ElementTree as E

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.owl").write_text(ONTOLOGY)
    (tmp_path / "in" / "none.owl").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o"><owl:Axiom>gone</owl:Axiom><owl:DatatypeProperty/></rdf:RDF>\n')
    counts = {r["file"]: (r["written"], r["skipped"]) for r in slims.write_slim(spark, str(tmp_path / "in"), str(tmp_path / "out"), "9606").collect()}
    assert counts == {"x.owl": (2, 2), "none.owl": (0, 0)}
    text = {d.name[5:]: "".join(p.read_text() for p in sorted(d.glob("part-*"))) for d in (tmp_path / "out").glob("file=*")}
    root = E.fromstring(text["x.owl"])
    about = [c.get("{r}about") for c in root if c.tag == "{o}Class"]
    assert about == [P + "X_1", None, P + "X_4"]
    assert [c.tag for c in root if c.tag != "{o}Class"] == ["{o}Ontology", "{o}ObjectProperty", "{o}NamedIndividual"]
    assert [c.tag for c in E.fromstring(text["none.owl"])] == ["{o}DatatypeProperty"]
    assert {r["about"] for r in files.ontology_classes(spark, str(tmp_path / "out" / "file=x.owl")).collect()} == {P + "X_1", P + "X_4"}


def test_all_parts_of_a_slim_are_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    classes = "".join(f'<owl:Class rdf:about="{P}X_{i}"><rdfs:label>n{i}</rdfs:label><rdfs:subClassOf><owl:Class rdf:about="{P}N"/></rdfs:subClassOf><owl:someValuesFrom rdf:resource="{P}NCBITaxon_1"/></owl:Class>\n' for i in range(20))
    (tmp_path / "in" / "x.owl").write_text(f'<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s" xmlns:dc="d"><owl:Ontology rdf:about="{P}x.owl"><dc:title>t</dc:title></owl:Ontology>\n{classes}<owl:ObjectProperty rdf:about="{P}R"><owl:inverseOf><owl:ObjectProperty rdf:about="{P}I"/></owl:inverseOf><rdfs:label>r</rdfs:label></owl:ObjectProperty></rdf:RDF>\n')
    slims.write_slim(spark, str(tmp_path / "in"), str(tmp_path / "out"), "1", per_file=3)
    slim = str(tmp_path / "out" / "file=x.owl")
    found = slims.classes(spark, slim).collect()
    assert {(r["about"], *r["labels"]) for r in found} == {(f"{P}X_{i}", f"n{i}") for i in range(20)} and len(found) == 20
    assert [r["title"] for r in slims.headers(spark, slim).collect()] == ["t"]
    assert [(r["about"], r["label"]) for r in slims.terms(spark, slim, ("owl:ObjectProperty",)).collect()] == [(P + "R", "r")]
    assert len({r["file"] for r in found}) > 5


def test_index_of_words_and_phrases(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search_index, "BLOCK", 3)
    rng = random.Random(8)
    texts = [" ".join(rng.choices(("the", "red", "Fox", "Éclair", "ran"), k=rng.randint(0, 12))) for _ in range(60)] + [None, "", "--", "the the the the"]
    fields = [("C", str(i), "f", t) for i, t in enumerate(texts)]
    search_index.write_index(spark.createDataFrame(fields + [fields[3]], "collection string, key string, field string, text string").repartition(5), str(tmp_path))
    clean = lambda t: (t or "").lower().replace("é", "e").replace("-", " ").split()
    found = {}
    for r in search_index.postings(spark, str(tmp_path)).collect():
        assert r["places"] == sorted(r["places"]) and r["norm"] >= len(r["places"])
        found[r["token"]] = found.get(r["token"], 0) + len(r["places"])
    every = [w for t in texts + [texts[3]] for w in clean(t)]
    assert found == {w: every.count(w) for w in set(every)}
    phrases = ["the red", "RED fox ran", "eclair", "the the", "missing", "the missing", "", "--", None, "the red"]
    got = sorted((r["phrase"], r["key"], r["n"], r["first"], round(r["score"], 6)) for r in search_index.phrase_search(spark, str(tmp_path), spark.createDataFrame([(p,) for p in phrases], "phrase string")).collect())
    wanted = []
    for p in {p for p in phrases if clean(p)}:
        w = clean(p)
        for i, t in [*enumerate(texts), (3, texts[3])]:
            at = [k for k in range(len(clean(t)) - len(w) + 1) if clean(t)[k : k + len(w)] == w]
            if at:
                wanted.append((p, str(i), len(at), at[0], round(len(at) / len(clean(t)), 6)))
    assert got == sorted(wanted)


def test_first_success_and_states(spark):
    kinds = spark.createDataFrame([("Has", "RO_1", ["size"], None), ("Is", "RO_2", [], None), ("Was", "RO_3", [], "no data"), ("Odd", "RO_4", [], None)], "association string, predicate string, required array<string>, no_data string")
    rows = [
        ("Has", "k1", "a", 1, 5, "A_1", None, {"size": "3"}), ("Has", "k1", "b", 2, 9, "A_1", "B_1", {"size": "3"}), ("Has", "k1", "b", 2, 7, "A_1", "B_2", {"size": "4"}), ("Has", "k1", "c", 3, 1, "A_1", "B_3", {"size": "4"}),
        ("Has", "k2", "a", 1, 1, "A_2", "B_1", {"size": ""}), ("Has", "k2", "b", 2, 1, None, "B_1", {"size": "1"}),
        ("Is", "k1", "a", 1, 1, "", "B_1", {}), ("Nothing", "k1", "a", 1, 1, "A", "B", {}),
    ]
    frame = spark.createDataFrame([(*r, None) for r in rows], "association string, key string, source string, source_rank int, seq long, subject string, object string, fields map<string,string>, notes string")
    found, unknown = A.judged(frame, kinds)
    best = A.first_success(found)
    assert {(r["association"], r["key"]): (r["status"], r["source"], r["object"], r["tried"]) for r in best.collect()} == {("Has", "k1"): ("Created", "b", "B_2", 4), ("Has", "k2"): ("Partial", "a", "B_1", 2), ("Is", "k1"): ("Failed", "a", "B_1", 1)}
    assert [r["association"] for r in unknown.collect()] == ["Nothing"]
    report = {r["status"]: (r["associations"], r["n"]) for r in A.state_report(A.states(best, kinds)).collect()}
    assert report == {"Created": (1, 1), "Partial": (1, 1), "Failed": (1, 1), "Not possible": (1, 0), "Not handled": (1, 0)}
    tuples = A.created_tuples(best, edge_fields=("size",)).collect()
    assert {r["key"] for r in tuples} == {"k1"} and len(tuples) == 3
    none = A.first_success(A.judged(frame.limit(0), kinds)[0])
    assert {r["status"]: r["associations"] for r in A.state_report(A.states(none, kinds)).collect()} == {"Created": 0, "Partial": 0, "Failed": 0, "Not possible": 1, "Not handled": 3}


def test_annotations_are_scanned_with_their_identifiers(spark, tmp_path):
    import json

    record = {"subject_type": "Cell_set", "subject_name": "a b", "subject_identifier": "u1-x", "relation": "r", "object_type": "Gene", "object_name": "G1", "object_identifier": "i", "extra": 1}
    (tmp_path / "array.json").write_text(json.dumps([record, {**record, "id": "own"}, {**record, "subject_name": None}], indent=4))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(json.dumps(r) for r in [record, {**record, "object_name": "G2"}]))
    rows = files.annotation_records(spark, str(tmp_path / "array.json")).collect()
    assert [r["subject_identifier"] for r in rows] == ["u1-x"] * 3 and len({r["id"] for r in rows}) == 3 and "own" in {r["id"] for r in rows}
    assert {r["file"] for r in rows} == {"array.json"}
    more = files.annotation_records(spark, str(tmp_path / "lines"), lines=True)
    assert {r["object_name"] for r in more.collect()} == {"G1", "G2"}
    from weftgraph.operators import legacy

    made = legacy.annotation_tuples(more, spark.createDataFrame([], "mesh string, mondo string"), spark.createDataFrame([("r", "RO_1")], "relation string, predicate string"))
    assert {(r["s"], r["o"]) for r in made.where("arity = 3 AND p LIKE '%RO_1'").collect()} == {(f"{P}CS_a-b-u1", f"{P}GS_G1"), (f"{P}CS_a-b-u1", f"{P}GS_G2")}


def test_members_of_patterns_are_those_of_their_paths(spark):
    from weftgraph.operators import patterns

    rng = random.Random(4)
    nodes = {c: [f"{c}/{i}" for i in range(6)] for c in "ABCD"}
    pairs = {(rng.choice(nodes[a]), rng.choice(nodes[b])) for a, b in ("AB", "BC", "CA", "CD", "BC", "AB") for _ in range(4)}
    rows = [(f"{a[0]}-{b[0]}", f"{a[2:]}-p-{b[2:]}", a, b, ["P"]) for a, b in sorted(pairs)] + [("C-C", f"{i}-up-{i + 1}", f"C/{i}", f"C/{i + 1}", ["UP"]) for i in range(1, 5)]
    edges = spark.createDataFrame(rows, "collection string, key string, src string, dst string, labels array<string>")
    text = "A B\nA B C\nA B C D\nD C A\nB A D\nA C + UP"
    near = [(f"{c}/{k}", a, b) for c, k, a, b, _ in rows if a[0] != b[0]]
    near += [(e, b, a) for e, a, b in near]
    wanted = set()
    for steps, label in patterns.parsed(text):
        name = " ".join(steps) + (f" + {label}" if label else "")
        paths = [((a, b), (e,)) for e, a, b in near if (a[0], b[0]) == steps[:2]]
        for c in steps[2:]:
            paths = [((*v, b), (*es, e)) for v, es in paths for e, a, b in near if a == v[-1] and b[0] == c]
        for v, es in paths:
            wanted |= {(name, "vertex", x) for x in v} | {(name, "edge", e) for e in es}
            if label:
                wanted |= {(name, "vertex", f"C/{i}") for i in range(int(v[-1][2:]), 6) if int(v[-1][2:]) >= 1}
    assert {tuple(r) for r in patterns.pattern_members(edges, patterns.parsed(text)).collect()} == wanted
    every = patterns.parsed(patterns.PHENOTYPE)
    assert len(every) == 49 and all(p[0][0] == "CS" for p in every) and sum(p[1] is not None for p in every) == 18
    for bad in ("A", "A B A"):
        try:
            patterns.pattern_members(edges, patterns.parsed(bad))
        except ValueError:
            continue
        raise AssertionError(bad)


def test_edges_of_patterns_are_stored_once(spark):
    from pathlib import Path

    from weftgraph.operators import patterns

    rows = [(f"{x}-{y}", f"{i}-p-{j}", f"{x}/{i}", f"{y}/{j}", ["P"]) for x, y in ("AB", "CB", "XA") for i in range(6) for j in range(6)]
    edges = spark.createDataFrame(rows, "collection string, key string, src string, dst string, labels array<string>")
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    made = patterns.pattern_members(edges, patterns.parsed("A B\nA B C\nC B A"), repeated=False)
    count = lambda path: spark.read.parquet(str(path)).count()
    # of edges those of the patterns; of vertices those of A and C with an edge to B, and those of B by either neighbour
    assert sum(count(path) for path in set(folder.iterdir()) - before) == 2 * 36 + 4 * 6
    assert made.count() == 36 + 12 + 2 * (72 + 18)


def test_members_with_many_vertices_left_out(spark, monkeypatch):
    from weftgraph.operators import patterns

    rng = random.Random(6)
    pick = lambda c: f"{c}/{rng.randrange(9)}"
    pairs = sorted({(pick(a), pick(b)) for a, b in ("AB", "BC", "CD", "DB", "AB", "BC", "CD") for _ in range(4)})
    rows = [(f"{a[0]}-{b[0]}", f"{a[2:]}-p-{b[2:]}", a, b, ["P"]) for a, b in pairs]
    near = [(f"{c}/{k}", a, b) for c, k, a, b, _ in rows]
    near += [(e, b, a) for e, a, b in near]
    text, wanted = "A B C D\nD C B\nB D C\nA B D", []
    for steps, _ in patterns.parsed(text):
        paths = [((a,), ()) for a in {a for _, a, _ in near if a[0] == steps[0]}]
        for c in steps[1:]:
            paths = [((*v, b), (*es, e)) for v, es in paths for e, a, b in near if a == v[-1] and b[0] == c]
        wanted += [(" ".join(steps), kind, x) for kind, of in (("vertex", 0), ("edge", 1)) for x in {x for path in paths for x in path[of]}]
    assert 20 < len(wanted) < 4 * len(rows)
    schema = "collection string, key string, src string, dst string, labels array<string>"
    for sent, more in ((0, rows[:9]), (2, [])):  # by shuffles, or by what is left out or stays where that is little
        monkeypatch.setattr(patterns, "SENT", sent)
        found = patterns.pattern_members(spark.createDataFrame(rows + more, schema), patterns.parsed(text), bool(more))
        assert sorted(tuple(r) for r in found.collect()) == sorted(wanted)


def test_blank_node_sets(spark):
    from weftgraph.operators import reports

    whole = [("X", "s#subClassOf", "_:1"), ("_:1", "o#onProperty", "p"), ("_:1", "o#someValuesFrom", "Y")]
    short = [("X", "s#subClassOf", "_:2"), ("_:2", "o#onProperty", "p")]
    twice = [("_:3", "o#annotatedSource", "X"), ("_:3", "o#annotatedProperty", "p"), ("_:3", "o#annotatedProperty", "q"), ("_:3", "o#hasDbXref", "lost")]
    noted = [("_:4", "o#annotatedSource", "X"), ("_:4", "o#annotatedProperty", "p"), ("_:4", "o#annotatedTarget", "text"), ("_:4", "o#source", "a"), ("_:4", "o#hasDbXref", "b")]
    rest = [("_:5", "o#member", "_:1"), ("_:5", "o#member", "other"), ("plain", "o#p", "plain"), ("_:6", "o#source", "alone")]
    frame = spark.createDataFrame(whole + short + twice + noted + rest, "s string, p string, o string")
    made, ignored = reports.bnode_triples(reports.bnode_sets(frame))
    assert {tuple(r) for r in made.collect()} == {("relation", "X", "p", "Y"), ("annotation", "X", "p", "text"), ("literal", "X", "o#source", "a"), ("literal", "X", "o#hasDbXref", "b")}
    assert sorted((r["s"], r["p"], r["o"]) for r in ignored.collect()) == sorted(short + twice + [x for x in rest if x[0] != "plain"])


def test_bags_differ_by_what_they_hold_at_any_depth(spark):
    from pyspark.sql import functions as F

    from weftgraph.operators import reports

    deep = '{"a":' * 9 + "%s" + "}" * 9
    docs = {
        1: ('{"l":[1,2,2,null],"o":[{"id":"x","v":1},{"id":"y","v":2}]}', '{"o":[{"v":2,"id":"y"},{"v":1,"id":"x"}],"l":[2,null,1,2]}'),
        2: ('{"l":[1,2]}', '{"l":[2,2]}'),
        3: (deep % '["p",["q","r"]]', deep % '[["r","q"],"p"]'),
        4: (deep % "1", deep % "2"),
        5: ("{}", "{}"),
        6: ('{"l":[]}', '{"l":"text"}'),
    }
    frame = lambda k: spark.createDataFrame([(i, d[k]) for i, d in docs.items()], "key int, j string").select("key", F.try_parse_json("j").alias("v"))
    got = {(r["key"], r["path"], r["problem"]) for r in reports.bag_difference(frame(0), frame(1), "key", "v").collect()}
    path = "$" + ".a" * 9
    assert got == {(2, "$.l[1]", "missing"), (2, "$.l[2]", "value"), (4, path, "value"), (6, "$.l[]", "missing"), (6, "$.l", "extra")}


def test_names_and_namespaces(spark):
    from weftgraph.operators import namespaces

    spaces = spark.createDataFrame([("a", "http://a/"), ("b", "http://a/"), ("ab", "http://a/b"), ("c", "http://z/"), ("c", "http://y/"), (None, "http://n/"), ("e", "")], "prefix string, uri string")
    uris = ["http://a/x", "http://a/bx", "http://a/b", "http://a", "http://z/1", None, "", "http://n/1", "http://a/x"]
    got = sorted(((r["u"], r["prefix"], r["local"]) for r in namespaces.contracted(spark.createDataFrame([(u,) for u in uris], "u string"), "u", spaces).collect()), key=str)
    assert got == sorted([("http://a/x", "a", "x"), ("http://a/bx", "ab", "x"), ("http://a/b", "ab", ""), ("http://a", None, None), ("http://z/1", "c", "1"), (None, None, None), ("", None, None), ("http://n/1", None, None), ("http://a/x", "a", "x")], key=str)
    curies = ["c:1", "ab:x:y", "none", "q:1", None]
    made = {r["k"]: r["expanded"] for r in namespaces.expanded(spark.createDataFrame([(c,) for c in curies], "k string"), "k", spaces).collect()}
    assert made == {"c:1": "http://y/1", "ab:x:y": "http://a/bx:y", "none": None, "q:1": None, None: None}
    none = namespaces.contracted(spark.createDataFrame([("http://a/",)], "u string"), "u", spaces.limit(0)).collect()
    assert [(r["prefix"], r["local"]) for r in none] == [(None, None)]


def test_keyed_store_rewrites_touched_buckets_only(spark, tmp_path):
    from weftgraph.operators import keyed_store

    folder, schema = str(tmp_path / "s"), "id string, payload string, seq long"
    now = lambda: {r["id"]: r["payload"] for r in keyed_store.current(spark, folder).collect()}
    merge = lambda rows, n: keyed_store.merge(spark.createDataFrame(rows, schema), folder, n)
    assert now() == {}
    assert merge([(str(i), f'{{"v":{i}}}', i) for i in range(100)] + [(None, "x", 1)], 0)
    assert merge([("1", "old", 1), ("1", 'a "quoted"\n', 2), ("2", None, 1), ("new", "n", 1)], 1)
    assert not merge([("3", None, 9)], 1) and merge([], 2)
    wanted = {str(i): f'{{"v":{i}}}' for i in range(100) if i != 2} | {"1": 'a "quoted"\n', "new": "n"}
    assert now() == wanted
    touched = [p.name for p in (tmp_path / "s" / "merge=1").glob("bucket=*")]
    assert 1 <= len(touched) <= 3
    (tmp_path / "s" / "merge=3").mkdir()  # a merge that broke off
    assert now() == wanted and merge([(k, None, 1) for k in wanted], 3) and now() == {}
