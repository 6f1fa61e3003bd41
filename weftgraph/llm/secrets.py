"""Secret scans on an incremental blob ledger, with DataFrame functions only.

Every text - every version of a document is a row - is addressed by the SHA-256 of its content. The ledger is a table
with one row for each blob and run that scanned it: the rule versions applied and what they found. A run reads the
ledger, scans each distinct blob for the rule versions it has not met, appends what it found, and joins the findings of
all runs to every document with that content. A rule is a pattern, the least length of the part that counts, and a
version; matches are leftmost, non-overlapping and dropped afterwards if too short. Where a match starts follows from the
lengths of the stretches between matches and of the matches before it.

Defined cases: null texts count as empty; repeated texts are one blob; documents without findings get counts of 0, the
digest of the empty string and an empty list; null doc_ids keep their rows; texts may be of any length that one row can
hold; columns of any name pass through ``redacted``; other columns are ignored by ``report``; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import materialise, shared_folder

#: Findings that are sent to all executors at most when texts are redacted; with more, texts are shuffled.
SENT = 100_000
FOUND = "array<struct<rule:string,start:bigint,end:bigint>>"
LEDGER = f"blob string, rules array<string>, found {FOUND}"


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str  # the same in Java's and RE2's syntax
    group: int
    least: int  # characters of the group
    base: bool = True

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


def either_case(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


# fixed values: the base rules in the order of their contract; runs of one class are matched whole, so a least length
# may stand in the pattern of those
RULES = (
    Rule("assign", 1, "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
    Rule("pem", 2, "-----BEGIN [A-Z ]*PRIVATE KEY-----(?s:.*?-----END [A-Z ]*PRIVATE KEY-----)?", 0, 1, base=False),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, base=False),
)


def address(text: Column) -> Column:
    """The address of a text's content."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _stretches(text: Column, number: int, rule: Rule) -> Column:
    """Of each match: the rule, its place in order, characters since the last match, in the match, and that count."""
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.slice(F.split(text, rule.pattern, -1), 1, F.size(F.regexp_extract_all(text, pattern, F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    row = lambda x, i: F.struct(F.lit(number).alias("rule"), i.alias("i"), F.char_length(x["gap"]).alias("gap"), F.char_length(x["all"]).alias("size"), F.char_length(x["part"]).alias("part"))
    return F.transform(found, row)


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rules, found) of blobs (blob, text, todo), where todo has the names of the rules to apply."""
    nothing = F.array().cast("array<struct<rule:int,i:int,gap:int,size:int,part:int>>")
    text = F.col("text")
    each = [F.when(F.array_contains("todo", rule.name) & text.rlike(rule.pattern), _stretches(text, k, rule)).otherwise(nothing) for k, rule in enumerate(rules)]
    met = blobs.select("blob", "todo", F.explode_outer(F.concat(*each)).alias("m")).select("blob", "todo", "m.*")
    order = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.create_map(*[F.lit(x) for k, rule in enumerate(rules) for x in (k, rule.least)]), F.col("rule"))
    name = F.element_at(F.array(*[F.lit(rule.name) for rule in rules]), F.col("rule") + 1)
    ends = met.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order).cast("long"))
    good = F.when(F.col("part") >= least, F.struct(name.alias("rule"), (F.col("end") - F.col("size")).alias("start"), "end"))
    return ends.groupBy("blob").agg(F.first("todo").alias("rules"), F.collect_list(good).cast(FOUND).alias("found"))


def unseen(documents: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The distinct blobs (blob, text, todo) of documents for which the ledger lacks a rule version."""
    blobs = documents.select(address(F.col("text")).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*[F.lit(rule.name) for rule in rules])
    if ledger is None:
        return blobs.select("blob", F.coalesce("text", F.lit("")).alias("text"), wanted.alias("todo"))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", F.coalesce("text", F.lit("")).alias("text"), todo.alias("todo")).where(F.size("todo") > 0)


def read_ledger(documents: DataFrame, path: str) -> DataFrame | None:
    """The ledger table at a path, or None where none has been written."""
    spark = documents.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(LEDGER).parquet(path) if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) else None


def scanned(documents: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger at ``path`` after a run over documents (text, ...); a new ledger in the shared folder, if no path is given.

    A run that is lost before its rows are committed leaves the ledger as it was, and the next one scans the same blobs.
    """
    path = path or f"{shared_folder(documents.sparkSession)}/weftgraph-ledger-{uuid.uuid4().hex}"
    scan(unseen(documents, read_ledger(documents, path), rules), rules).write.mode("append").parquet(path)
    return read_ledger(documents, path)


def by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Of each blob with findings of these rules in any run: how many of each, and all of them sorted by start and rule."""
    number = F.create_map(*[F.lit(x) for k, rule in enumerate(rules) for x in (rule.name, k)])
    now = F.filter("found", lambda x: x["rule"].isin([rule.name for rule in rules]))
    each = F.transform(now, lambda x: F.struct(x["start"].alias("start"), F.element_at(number, x["rule"]).alias("rule"), x["end"].alias("end")))
    found = ledger.where(F.size("found") > 0).groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(each)))).alias("found"))
    # a filter's function must take one parameter alone: a second one would be given the element's place
    many = lambda k: F.size(F.filter("found", lambda x: x["rule"] == k))
    counts = [many(k).alias(f"n_{rule.kind}") for k, rule in enumerate(rules)]
    return found.where(F.size("found") > 0).select("blob", *counts, "found")


def joined(found: Column, rules: tuple[Rule, ...], base_only: bool) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    if base_only:
        found = F.filter(found, lambda x: x["rule"].isin([k for k, rule in enumerate(rules) if rule.base]))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(kinds, x["rule"]), x["start"], x["end"])), ",")


def report(documents: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document, after a run on the ledger at a path."""
    found = by_blob(scanned(documents.select("text"), ledger, rules), rules)
    counts = [F.coalesce(f"n_{rule.kind}", F.lit(0)).cast("long").alias(f"n_{rule.kind}") for rule in rules if rule.base]
    base, spans = (F.coalesce(joined(F.col("found"), rules, b), F.lit("")) for b in (True, False))
    rows = documents.select("doc_id", address(F.col("text")).alias("blob")).join(found, "blob", "left")
    return rows.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def redacted(documents: DataFrame, mark: str = "[REDACTED]", rules: tuple[Rule, ...] = RULES, ledger: str | None = None) -> DataFrame:
    """documents (text, n_chars, ...) with every finding, overlapping ones together, replaced by a mark and ``n_chars`` counted anew."""
    found = materialise(by_blob(scanned(documents.select("text"), ledger, rules), rules).select("blob", "found"))
    if found.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0] <= SENT:
        found = F.broadcast(found)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    # the end of what is covered so far, and the text built so far; findings come sorted by start
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda a, x: F.when(
        x["start"] >= a["at"],
        F.struct(x["end"].alias("at"), F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mark)).alias("out")),
    ).otherwise(F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["out"].alias("out")))
    rest = lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2**31 - 1)))
    clean = F.when(F.col("found").isNull(), F.col("row.text")).otherwise(F.aggregate("found", start, step, rest))
    columns = documents.columns
    # the row travels as one struct, so that its columns may have any names
    rows = documents.select(address(F.col("text")).alias("blob"), F.struct(*[F.col(c) for c in columns]).alias("row"))
    out = rows.join(found, "blob", "left").withColumn("clean", clean)
    made = {"text": F.col("clean"), "n_chars": F.when(F.col("found").isNull(), F.col("row.n_chars")).otherwise(F.char_length("clean").cast("long"))}
    return out.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for ``report``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    scans = " UNION ALL ".join(
        f"""SELECT id, {k} AS rule, {quote(rule.kind)} AS kind, {str(rule.base).lower()} AS base, unnest(range(1, len(a) + 1)) AS i, g, a, p, {rule.least} AS least
        FROM (SELECT id, string_split_regex(text, {quote(rule.pattern)}) AS g, regexp_extract_all(text, {quote(rule.pattern)}) AS a,
                     regexp_extract_all(text, {quote(rule.pattern)}, {rule.group}) AS p FROM t)"""
        for k, rule in enumerate(rules)
    )
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE rule = {k}) AS BIGINT) AS n_{rule.kind}" for k, rule in enumerate(rules) if rule.base)
    zero = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in rules if rule.base)
    return f"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
met AS ({scans}),
spans AS (
  SELECT id, rule, kind, base, len(a[i]) AS size,
         CAST(list_sum(list_transform(g[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(a[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
  FROM met WHERE len(p[i]) >= least),
each AS (
  SELECT id, {counts},
         string_agg(concat(kind, ':', start, ':', start + size), ',' ORDER BY start, rule) FILTER (WHERE base) AS base_spans,
         string_agg(concat(kind, ':', start, ':', start + size), ',' ORDER BY start, rule) AS spans
  FROM spans GROUP BY id)
SELECT doc_id, {zero}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN each USING (id)"""
