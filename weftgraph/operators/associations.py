"""Associations from alternative sources, tried in order: the first that makes one is kept, and every association has a state.

A candidate is (association, key, source, source_rank, seq, subject, object, fields map<string,string>, notes): what one
source offers for one association. It is Created if subject, object and all fields that the association requires are there,
Partial if subject and object are, and Failed otherwise. Of the candidates of a key the best state is kept, then the source
that is tried first, then the first row; ``min_by`` combines them before anything is shuffled. Associations of the catalogue
without any candidate are Not possible, where a list says that no source has their data, or Not handled.

Defined cases: null and empty fields are missing; associations that the catalogue lacks are rejected, not dropped; equal
candidates count once for each row; without candidates every association is Not possible or Not handled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.functions.terms import PURL
from weftgraph.operators.writers import annotations, emit, quintuple, triple

STATES = ("Created", "Partial", "Failed", "Not possible", "Not handled")


def candidates(rows: DataFrame, association: str, source: str, rank: int, key: Column, subject: Column, object_: Column, fields: dict[str, Column], seq: Column, notes: Column | None = None) -> DataFrame:
    """The candidates that a source's rows make for an association."""
    none = F.lit(None).cast("string")
    named = F.map_from_arrays(F.array(*map(F.lit, fields)), F.array(*[c.cast("string") for c in fields.values()])) if fields else F.create_map().cast("map<string,string>")
    return rows.select(
        F.lit(association).alias("association"), key.cast("string").alias("key"), F.lit(source).alias("source"), F.lit(rank).alias("source_rank"), seq.cast("long").alias("seq"),
        subject.alias("subject"), object_.alias("object"), named.alias("fields"), (none if notes is None else notes).alias("notes"),
    )


def judged(rows: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates with their ``status`` and the fields that are ``missing``, by the catalogue (association, predicate, required
    array<string>, no_data); and those of associations that it lacks. The catalogue has a row for each kind of association."""
    small = F.broadcast(catalogue.select("association", "predicate", "required"))
    there = lambda c: F.coalesce(c != "", F.lit(False))
    missing = F.filter("required", lambda f: ~there(F.try_element_at("fields", f)))
    ends = there(F.col("subject")) & there(F.col("object"))
    status = F.when(~ends, "Failed").when(F.size(missing) > 0, "Partial").otherwise("Created")
    found = rows.join(small, "association").select(*rows.columns, "predicate", missing.alias("missing"), status.alias("status"))
    return found, rows.join(small, "association", "left_anti")


def first_success(found: DataFrame) -> DataFrame:
    """Of each (association, key) the candidate that holds, with how many were tried up to it and how many there were."""
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("status")).cast("int")
    order = F.struct(rank.alias("state"), "source_rank", "seq", "subject", "object")
    columns = [c for c in found.columns if c not in ("association", "key")]
    best = found.groupBy("association", "key").agg(F.min_by(F.struct(*columns), order).alias("x"), F.count("*").alias("tried"))
    return best.select("association", "key", "x.*", "tried")


def states(best: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(association, status, n, sources, notes) of every association: how many keys are in each state that occurs, and through which
    sources; those without candidates are Not possible (with why), where the catalogue says so in ``no_data``, or Not handled."""
    counted = best.groupBy("association", "status").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("sources"))
    none = catalogue.join(counted.select("association").distinct(), "association", "left_anti").select(
        "association", F.when(F.col("no_data").isNotNull(), "Not possible").otherwise("Not handled").alias("status"), F.lit(0).cast("long").alias("n"), F.array().cast("array<string>").alias("sources"), F.col("no_data").alias("notes")
    )
    return counted.withColumn("notes", F.lit(None).cast("string")).unionByName(none)


def state_report(states: DataFrame) -> DataFrame:
    """(status, associations, n): how many kinds of association, and how many keys, are in each of the five states."""
    every = F.explode(F.array(*map(F.lit, STATES))).alias("status")
    all_of = states.sparkSession.range(1).select(every)
    counted = states.groupBy("status").agg(F.count_distinct("association").alias("associations"), F.sum("n").alias("n"))
    return all_of.join(counted, "status", "left").select("status", F.coalesce("associations", F.lit(0)).cast("long").alias("associations"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def created_tuples(best: DataFrame, subject_fields: tuple[str, ...] = (), object_fields: tuple[str, ...] = (), edge_fields: tuple[str, ...] = ()) -> DataFrame:
    """(association, key, seq, arity, s, p, o, attr, value) of the Created ones alone: relation, source, and the named fields as
    annotations of subject or object, or as attributes of the edge. Subjects and objects are terms."""
    s, o = (F.concat(F.lit(PURL), c) for c in ("subject", "object"))
    field = lambda name: F.try_element_at("fields", F.lit(name))
    tuples = [triple(s, F.col("predicate"), o), quintuple(s, F.col("predicate"), o, "Source", F.col("source"))]
    tuples += annotations(s, {name: field(name) for name in subject_fields}) + annotations(o, {name: field(name) for name in object_fields})
    tuples += [quintuple(s, F.col("predicate"), o, name, field(name)) for name in edge_fields]
    return emit(best.where("status = 'Created'"), tuples, "association", "key")


