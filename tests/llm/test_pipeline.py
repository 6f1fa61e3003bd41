"""The pipeline's stages against brute force on the smallest tables, and on rows with nulls, repeats and clashing columns."""

import re
import zlib

import pytest
from conftest import TINY
from test_operators import brute_components

import corpus_pipeline
from weftgraph.llm import language_id, quality_rules
from weftgraph.llm.common import materialise, table
from weftgraph.llm.entry import vocabulary_path

RULES = (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), re.compile("AKIA[A-Z0-9]{16,}"), re.compile("[0-9a-f]{24,}"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"))


def redacted(text):
    spans = sorted((m.start(), m.end()) for k, rule in enumerate(RULES) for m in rule.finditer(text) if k or len(m[2]) >= 6)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[REDACTED]"
        at = max(at, b)
    return out + text[at:]


def test_stages_one_by_one(spark):
    """What each stage keeps and changes, from the operators' own verdicts or a brute-force version of them."""
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, TINY, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    judged = {r.doc_id for r in quality_rules.judge(docs, table(spark, TINY, "labels")).where("kept").collect()}
    docs = materialise(stages["quality rules"](spark, docs, TINY))
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == judged < set(rows)
    told = {r.doc_id: r.lang_pred for r in language_id.identify(docs).collect()}
    docs = materialise(stages["language ID"](spark, docs, TINY))
    spoken = {r.doc_id for r in docs.collect()}
    assert docs.columns == columns and spoken <= judged and all(told[i] != "und" for i in spoken) and len(spoken) >= 0.95 * len(judged)
    one = {i for i, (_, c) in brute_components([(i, rows[i].text) for i in spoken]).items() if c == i}
    docs = materialise(stages["n-gram Jaccard join"](spark, docs, TINY))
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == one and docs.count() == len(one)
    docs = materialise(stages["secret scans"](spark, docs, TINY))
    clean = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(clean) == one
    for i, r in clean.items():
        assert r.text == redacted(rows[i].text) and r.n_chars == (rows[i].n_chars if r.text == rows[i].text else len(r.text)) and r.lang == rows[i].lang
    packed = stages["best-fit packing"](spark, docs, TINY).toPandas()
    library = Tokenizer.from_file(vocabulary_path())
    for i, part in packed.groupby("doc_id"):
        assert part.length.sum() == len(library.encode(clean[i].text, add_special_tokens=False).ids) + 1
    assert set(packed.doc_id) == one and packed.groupby("sequence_id").length.sum().max() <= 2048
    assert all(zlib.crc32(b"") <= c < 2**32 for c in packed.ids_crc32)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, name, stage):
    docs = table(spark, TINY, "documents").selectExpr("*", "1 AS letters", "'x' AS blob", "2.5D AS found", "true AS kept", "'c' AS chunk", "0 AS component_id", "1 AS row")
    docs = docs.union(docs.limit(3)).union(docs.limit(1).selectExpr(*[f"CAST(NULL AS {kind}) AS `{c}`" for c, kind in docs.dtypes]))
    made = stage(spark, docs, TINY)
    assert made.columns == docs.columns and made.count() > 0
    assert all((r.letters, r.blob, r.found, r.kept, r.chunk, r.component_id, r.row) == (1, "x", 2.5, True, "c", 0, 1) for r in made.where("letters IS NOT NULL").collect())
    assert stage(spark, docs.limit(0), TINY).count() == 0
