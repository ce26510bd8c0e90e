"""Catalog documents (RDF/XML) as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import fixed_values as V
from quire.functions.catalog import file_key

_VALUES = "ARRAY<STRUCT<_VALUE: STRING>>"
_DESCRIBED = f"ARRAY<STRUCT<`rdf:Description`: ARRAY<STRUCT<`rdf:value`: {_VALUES}>>>>"
# Only the elements that are read; the rest of a catalog document is not converted.
CATALOG_SCHEMA = (
    "`pgterms:ebook` ARRAY<STRUCT<"
    f"`pgterms:bookshelf`: {_DESCRIBED}, "
    f"`pgterms:marc908`: {_VALUES}>>"
)


# An entry as it stands in its document, and the first language at any depth within it.
_COMMENT = r"(?s)<!--.*?-->"
_ENTRY = r"(?s)<pgterms:ebook(?=[\s/>])(?:[^>]*/>|.*?</pgterms:ebook\s*>)"
_LANGUAGE = "(//*[name()='dcterms:language']/*[name()='rdf:Description']/*[name()='rdf:value'])[1]"


def _described(elements: Column) -> Column:
    """The value elements of every description below the elements, in document order."""
    descriptions = F.flatten(F.transform(elements, lambda e: e["rdf:Description"]))
    return F.transform(descriptions, lambda d: d["rdf:value"])


def _first_values(elements: Column) -> Column:
    """The first value of every description that has one; empty ones are null."""
    present = F.filter(_described(elements), lambda v: F.size(v) > 0)
    return F.transform(present, lambda v: F.get(v, F.lit(0))["_VALUE"])


def read_catalog(spark: SparkSession, path: str, glob: str = V.CATALOG_FILE_GLOB) -> DataFrame:
    """One row per catalog entry: ``(book_id, lang, shelves, marc908)``.

    Folders are searched recursively. A document that is not well-formed gives no row at all.
    ``lang`` is the first language value at any depth of the entry, null where it is empty; ``shelves`` keeps repeated values
    and drops empty ones. Values are taken as they stand, surrounding spaces included; one of white
    space only is empty.
    Land the result as Parquet (see ``quire.sinks``): every later question then reads columns
    instead of parsing XML again.
    """
    documents = (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
        .select(
            file_key(F.col("_metadata.file_name")).alias("book_id"),
            F.from_xml("value", CATALOG_SCHEMA, {"ignoreSurroundingSpaces": "false"}).alias("document"),
            F.regexp_extract_all(F.regexp_replace("value", _COMMENT, ""), F.lit(_ENTRY), F.lit(0)).alias("texts"),
        )
    )
    # A document that is not well-formed has no entries here, so only sound ones are looked into.
    entry = documents.select("book_id", "texts", F.posexplode(F.col("document")["pgterms:ebook"]).alias("i", "e"))
    language = F.xpath_string(F.get("texts", F.col("i")), F.lit(_LANGUAGE))
    shelves = F.filter(
        _first_values(F.col("e")["pgterms:bookshelf"]), lambda v: v.isNotNull() & (v != "")
    )
    return entry.select(
        "book_id",
        F.when(language.rlike(r"\S"), language).alias("lang"),
        F.coalesce(shelves, F.array().cast("array<string>")).alias("shelves"),
        F.get(F.col("e")["pgterms:marc908"], F.lit(0))["_VALUE"].alias("marc908"),
    )
