"""The property graph that the shared tables stand for, as tuples: literal triples, link triples and quintuples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.functions.terms import PURL, RDFS

VALID = ("REGION", "NATION", "CUST", "SUPP", "PART", "ORD", "TURN")
SCHEMA = PURL + "schema#"
#: Labels of predicates without a fragment: (term, label).
PREDICATES = {"BFO_0000050": "part of", "RO_0001025": "located in", "RO_0000057": "has participant", "RO_0002351": "has member", "RO_0003001": "produced by"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uri(collection: str, *key: Column | str) -> Column:
    return F.concat(F.lit(f"{PURL}{collection}_"), *[F.col(k) if isinstance(k, str) else k for k in key])


def turn_key(turn: Column) -> Column:
    return (F.col("conv_id") * 1000 + turn).cast("string")


def _triples(frame: DataFrame, rank: int, s: Column, p: str, o: Column, seq: Column) -> DataFrame:
    return frame.select(F.lit(rank).alias("file_rank"), seq.cast("long").alias("seq"), s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"))


def literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal triples (file_rank, seq, s, p, o)."""
    out = []
    for rank, (name, collection, key, fields) in enumerate(
        (
            ("region", "REGION", "r_regionkey", {"r_name": RDFS + "label"}),
            ("nation", "NATION", "n_nationkey", {"n_name": RDFS + "label"}),
            ("customer", "CUST", "c_custkey", {"c_name": RDFS + "label", "c_mktsegment": SCHEMA + "Segment"}),
            ("supplier", "SUPP", "s_suppkey", {"s_name": RDFS + "label"}),
            ("part", "PART", "p_partkey", {"p_name": RDFS + "label", "p_brand": SCHEMA + "Brand", "p_type": SCHEMA + "Type"}),
            ("orders", "ORD", "o_orderkey", {"o_orderstatus": SCHEMA + "Status"}),
        )
    ):
        frame = table(spark, sf_dir, name)
        out += [_triples(frame, rank, uri(collection, key), p, F.col(c), F.col(key)) for c, p in fields.items()]
    first, *rest = out
    for frame in rest:
        first = first.unionByName(frame)
    return first.where("o IS NOT NULL")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples between terms (file_rank, seq, s, p, o)."""
    read = lambda name: table(spark, sf_dir, name)
    items = read("lineitem")
    part = read("part").where("p_partkey > 0")
    turn = read("conversations").where("turn > 0")
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    out = [
        _triples(read("nation"), 0, uri("NATION", "n_nationkey"), PURL + "BFO_0000050", uri("REGION", "n_regionkey"), F.col("n_nationkey")),
        _triples(read("customer"), 1, uri("CUST", "c_custkey"), PURL + "RO_0001025", uri("NATION", "c_nationkey"), F.col("c_custkey")),
        _triples(read("supplier"), 2, uri("SUPP", "s_suppkey"), PURL + "RO_0001025", uri("NATION", "s_nationkey"), F.col("s_suppkey")),
        _triples(read("orders"), 3, uri("ORD", "o_orderkey"), PURL + "RO_0000057", uri("CUST", "o_custkey"), F.col("o_orderkey")),
        _triples(items, 4, uri("ORD", "l_orderkey"), PURL + "RO_0002351", uri("PART", "l_partkey"), seq),
        _triples(items, 5, uri("PART", "l_partkey"), PURL + "RO_0003001", uri("SUPP", "l_suppkey"), seq),
        _triples(part, 6, uri("PART", "p_partkey"), RDFS + "subClassOf", uri("PART", F.floor(F.col("p_partkey") / 2).cast("string")), F.col("p_partkey")),
        _triples(turn, 7, uri("TURN", turn_key(F.col("turn"))), PURL + "BFO_0000050", uri("TURN", turn_key(F.col("turn") - 1)), F.col("conv_id")),
    ]
    first, *rest = out
    for frame in rest:
        first = first.unionByName(frame)
    return first


def quintuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of ORD-PART edges (file_rank, seq, s, p, o, attr, value), several for one edge; some name no edge."""
    items = table(spark, sf_dir, "lineitem")
    out = None
    for rank, (column, name) in enumerate((("l_quantity", "Quantity"), ("l_returnflag", "Return_flag"))):
        made = items.select(
            F.lit(rank).alias("file_rank"),
            (F.col("l_linenumber")).cast("long").alias("seq"),
            uri("ORD", "l_orderkey").alias("s"),
            F.lit(PURL + "RO_0002351").alias("p"),
            uri("PART", (F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)).cast("string")).alias("o"),
            F.lit(SCHEMA + name).alias("attr"),
            F.col(column).cast("string").alias("value"),
        )
        out = made if out is None else out.unionByName(made)
    return out


def predicate_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PREDICATES.items()), "term string, label string")
