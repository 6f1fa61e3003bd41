"""Identifiers, predicates and literals as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: ids of terms that become vertices
VALID_IDS = ("BGS", "BMC", "CHEBI", "CHEMBL", "CL", "CS", "CSD", "GO", "GS", "HP", "HsapDv", "MONDO", "NCBITaxon", "NCT", "Orphanet", "PATO", "PR", "PUB", "UBERON")
# fixed values: labels and sources that aren't just upper-cased
EDGE_LABELS = {
    "subClassOf": "SUB_CLASS_OF",
    "disjointWith": "DISJOINT_WITH",
    "crossSpeciesExactMatch": "CROSS_SPECIES_EXACT_MATCH",
    "exactMatch": "EXACT_MATCH",
    "equivalentClass": "EQUIVALENT_CLASS",
    "seeAlso": "SEE_ALSO",
}
EDGE_SOURCES = {"mondo-simple": "MONDO", "taxslim": "NCBITAXON", "go-plus": "GO", "uberon-base": "UBERON"}
PURL = "http://purl.obolibrary.org/obo/"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"


def _lookup(table: dict[str, str], key: Column, other: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key), other)


def normalise_uri(uri: Column) -> Column:
    """The first ``/pcl/CS`` becomes ``/PCLCS_``, or else the first ``/ensembl/ENSG`` becomes ``/ENSG_``."""
    once = lambda a, b: F.concat(F.substring_index(uri, a, 1), F.lit(b), F.substr(uri, F.instr(uri, a) + F.lit(len(a))))
    return F.when(uri.contains("/pcl/CS"), once("/pcl/CS", "/PCLCS_")).when(uri.contains("/ensembl/ENSG"), once("/ensembl/ENSG", "/ENSG_")).otherwise(uri)


def node_kind(value: Column) -> Column:
    """A value of a tuple is a URI if it contains ``http``."""
    return F.when(value.contains("http"), "uri").otherwise("literal")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once, however often the expression names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: URIs whose parts can be cut out as they are: no escapes, no ports, no queries, nothing that is normalised; with one
#: underscore in the last segment, or with a fragment.
_PLAIN = r"^https?://[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?:/[A-Za-z0-9._-]+)*"
PLAIN_TERM = _PLAIN + r"/[A-Za-z0-9.-]+_[A-Za-z0-9.-]+$"
PLAIN_PREDICATE = _PLAIN + r"/[A-Za-z0-9._-]+(?:#[A-Za-z0-9._-]+)?$"


def _plain(uri: Column, pattern: str) -> Column:
    return uri.rlike(pattern) & ~uri.contains("/pcl/CS") & ~uri.contains("/ensembl/ENSG")


def last_segment(uri: Column) -> Column:
    """The last segment of a URI's path, percent-decoded; null for what is no URI (a space, a bar or a ``<`` in it)."""
    path = F.try_url_decode(F.replace(F.try_parse_url(uri, F.lit("PATH")), F.lit("+"), F.lit("%2B")))
    return F.nullif(F.regexp_extract(path, "([^/]*)/*$", 1), F.lit(""))


def parse_term(uri: Column, valid: tuple[str, ...] = VALID_IDS) -> Column:
    """struct(term, id, number, is_valid) of a URI: exactly two parts around ``_`` (or else ``:``), or all null.

    Plain URIs, nearly all, are cut by generated code; the others go the way of expressions on their decoded path.
    """
    segment = F.substring_index(uri, "/", -1)
    before = F.substring_index(segment, "_", 1)
    cut = F.struct(segment.alias("term"), before.alias("id"), F.substring_index(segment, "_", -1).alias("number"), before.isin(*valid).alias("is_valid"))

    def parts(term: Column) -> Column:
        # trailing empty parts don't count
        found = F.when(term.contains("_"), F.split(F.regexp_replace(term, "_+$", ""), "_")).when(term.contains(":"), F.split(F.regexp_replace(term, ":+$", ""), ":"))
        return F.struct(term.alias("term"), found.alias("parts"))

    def fields(x: Column) -> Column:
        part = lambda k: F.when(F.size(x["parts"]) == 2, F.get(x["parts"], F.lit(k)))
        term = F.when(F.size(x["parts"]) == 2, x["term"])
        return F.struct(term.alias("term"), part(0).alias("id"), part(1).alias("number"), F.coalesce(part(0).isin(*valid), F.lit(False)).alias("is_valid"))

    return F.when(_usual(uri) | _plain(uri, PLAIN_TERM), cut).otherwise(let(let(let(let(uri, normalise_uri), last_segment), parts), fields))


#: What follows the usual base of a URI that can be cut out as it is.
_REST = r"^[A-Za-z0-9.-]+_[A-Za-z0-9.-]+$"


def _usual(uri: Column) -> Column:
    return uri.startswith(PURL) & F.substr(uri, F.lit(len(PURL) + 1)).rlike(_REST)


def valid_term(uri: Column, valid: tuple[str, ...] = VALID_IDS) -> Column:
    """The term ``id_number`` of a URI, null where ``parse_term`` finds none that is valid; for many rows.

    Nearly all URIs have the usual base and need the first branch only. Filters on it may be moved to where it is made, so it
    is one short expression.
    """
    rest = F.substr(uri, F.lit(len(PURL) + 1))
    usable = lambda term: F.when(F.substring_index(term, "_", 1).isin(*valid), term)

    def joined(term: Column) -> Column:
        split = F.when(term.contains("_"), F.split(F.regexp_replace(term, "_+$", ""), "_")).when(term.contains(":"), F.split(F.regexp_replace(term, ":+$", ""), ":"))
        return let(split, lambda x: F.when(F.size(x) == 2, F.array_join(x, "_")))

    other = let(let(let(let(uri, normalise_uri), last_segment), joined), usable)
    return F.when(_usual(uri), usable(rest)).otherwise(other)


def parse_predicate(uri: Column) -> Column:
    """struct(term, curie, label): the label is the fragment, or the term of a ``/dc/`` path, or null (a look-up's)."""

    def split(uri: Column) -> Column:
        path = F.try_parse_url(uri, F.lit("PATH"))
        return F.struct(F.substring_index(path, "/", -1).alias("term"), path.contains("/dc/").alias("dc"), F.try_parse_url(uri, F.lit("REF")).alias("fragment"))

    def fields(x: Column) -> Column:
        term, dc, fragment = x["term"], x["dc"], x["fragment"]
        curie = F.when(fragment.isNotNull(), F.concat(F.replace(term, F.lit("rdf-schema"), F.lit("rdfs")), F.lit(":"), fragment)).when(dc, F.concat(F.lit("dc:"), term)).otherwise(F.replace(term, F.lit("_"), F.lit(":")))
        return F.struct(term.alias("term"), curie.alias("curie"), F.coalesce(fragment, F.when(dc, term)).alias("label"))

    return let(let(let(uri, normalise_uri), split), fields)


def edge_label(label: Column) -> Column:
    return _lookup(EDGE_LABELS, label, F.replace(F.upper(label), F.lit(" "), F.lit("_")))


def edge_source(source: Column) -> Column:
    return _lookup(EDGE_SOURCES, source, F.upper(source))


def collection_of(document_id: Column) -> Column:
    """What stands before the first ``/``; null without one."""
    return F.when(document_id.contains("/"), F.substring_index(document_id, "/", 1))


def key_of(document_id: Column) -> Column:
    """What stands after the first ``/``; null without one."""
    return F.when(document_id.contains("/"), F.substr(document_id, F.instr(document_id, "/") + 1))


def self_referential(edge_collection: Column) -> Column:
    """Whether an edge collection ``A-B`` joins a vertex collection with itself."""
    left = F.substring_index(edge_collection, "-", 1)
    return edge_collection.contains("-") & (left == F.substr(edge_collection, F.instr(edge_collection, "-") + 1))


def hyphenate(text: Column) -> Column:
    return F.regexp_replace(text, "[ _,/-]+", "-")


def purl_to_curie(text: Column) -> Column:
    return F.regexp_replace(text, r"^https?://purl\.obolibrary\.org/obo/(\w+?)_(\d+)$", "$1:$2")


def curie_to_term(curie: Column) -> Column:
    return F.replace(curie, F.lit(":"), F.lit("_"))


def string_list(text: Column) -> Column:
    """The strings of a printed list (``"['a', 'b']"``); an empty array for anything else."""
    return F.coalesce(F.from_json(text, "array<string>", {"allowSingleQuotes": "true"}), F.array().cast("array<string>"))


def without_protocols(text: Column) -> Column:
    return F.regexp_replace(text, "https?://", "")


def as_number(text: Column, kind: str = "double") -> Column:
    """A number, or null for what is none (also for NaN)."""
    value = text.try_cast("double")
    value = F.when(~F.isnan(value), value)
    return value if kind == "double" else value.try_cast(kind)


def collected(array: Column, field: str) -> Column:
    """A field of all elements, joined by commas; the empty string for a missing list."""
    return F.coalesce(F.array_join(F.transform(array, lambda x: x[field]), ", "), F.lit(""))


def legacy_term(uri: Column) -> Column:
    """struct(id, number, term) of an OBO term; null ids for others and for ``GOREL``."""
    pattern = r"/obo/([A-Za-z]*)_([A-Za-z0-9+-]*)"
    a, b = (F.nullif(F.regexp_extract(uri, pattern, k), F.lit("")) for k in (1, 2))
    good = a.isNotNull() & b.isNotNull() & (a != "GOREL")
    return F.struct(F.when(good, a).alias("id"), F.when(good, b).alias("number"), F.when(good, F.concat_ws("_", a, b)).alias("term"))


def version_date(info: Column, iri: Column) -> Column:
    """The first ISO date of the version text, or else of the version IRI."""
    date = lambda c: F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return F.coalesce(date(info), date(iri))


def citation(authors: Column, year: Column, journal: Column | None = None) -> Column:
    """``A et al. (Y) J`` for several authors, ``A (Y) J`` for one."""
    first = F.when(F.size(authors) > 1, F.concat(F.get(authors, F.lit(0)), F.lit(" et al."))).otherwise(F.get(authors, F.lit(0)))
    base = F.concat(first, F.lit(" ("), year.cast("string"), F.lit(")"))
    return base if journal is None else F.concat(base, F.lit(" "), journal)


def citation_links(text: Column) -> Column:
    """struct(publication, collection): the links named in a citation text."""
    found = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    return F.struct(found(r"Publication:\s*(\S*)\s*Dataset Version:").alias("publication"), found(r"Collection:\s*(\S*)$").alias("collection"))


def last_accession(links: Column) -> Column:
    """The name of the last uniprot.org link of an array."""
    last = F.try_element_at(F.filter(links, lambda x: x.contains("uniprot.org")), F.lit(-1))
    return F.nullif(F.regexp_extract(last, r"([^/.]+)[^/]*$", 1), F.lit(""))


def short_id(*keys: Column) -> Column:
    """A 12-character id that depends on the keys alone."""
    return F.substring(F.sha2(F.concat_ws("\u0001", *keys), 256), 1, 12)
