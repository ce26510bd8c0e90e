"""Inputs of the registered queries, derived from the given tables by Spark.

The given tables hold no catalog, fetch results or book markers. These views derive them from
every row of ``documents``, so that the queries grow with it.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CURATED = [f"src{i}" for i in range(8)] + ["src98", "src99"]
MARKER = " the "
PATTERNS = 9
FIRST_ZIP = 6
# Of the compressed table; what a task makes of it is several times as much.
TASK_BYTES = 16 << 20

START = "Header line\n*** START OF THE PROJECT GUTENBERG EBOOK SAMPLE ***\n"
END = "\n*** END OF THE PROJECT GUTENBERG EBOOK SAMPLE ***\nFooter line"
TIGHT_START = "Header line\n***START OF THIS PROJECT GUTENBERG EBOOK SAMPLE***\n"
TIGHT_END = "\n***END OF THIS PROJECT GUTENBERG EBOOK SAMPLE***\nFooter line"
BARE_START = "Header line\n*** start of project gutenberg ebook sample ***\n"
LICENSE = "This line names a license\n\n"
BRACKETS = "\n[Illustration: one\npicture] [Footnote 1: see\nbelow] [Sidenote: aside] [sidenote: kept]"
NOTE = "Transcriber's Notes: made up\nfrom parts\n\n"
CONTENTS = "Front matter\n\n Contents \nPart one\nPart two\n\nCHAPTER 1\n"
BLANKS = "\n\n\n \n\n\n"
SHORT = "ab\n-\n"


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Only the named columns are read."""
    return spark.read.parquet(f"{folder}/documents.parquet").select(*columns)


def dealt(spark: SparkSession, folder: str) -> int:
    """Tasks to deal documents to: one per core, and more where one would get over ``TASK_BYTES`` of the table."""
    table = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/documents.parquet")
    size = table.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(table).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The given file may have a single split; these rows are dealt to all cores."""
    return documents(spark, folder, "doc_id", "text").repartition(dealt(spark, folder))


def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose key repeats, and is missing for one in thirteen."""
    d = texts(spark, folder)
    key = F.when(F.col("doc_id") % 13 != 0, (F.col("doc_id") % 40).cast("string"))
    return d.select(key.alias("doc_id"), "text")


def ebooks(spark: SparkSession, folder: str) -> DataFrame:
    d = documents(spark, folder, "doc_id", "lang", "source", "n_chars")
    tenth = F.col("doc_id") % 10
    note = F.concat(
        F.lit("Reading ease score: "), (F.col("n_chars") % 105).cast("string"), F.lit(".7 (grade)")
    )
    return d.select(
        F.col("doc_id").cast("string").alias("book_id"),
        "lang",
        F.array(
            F.col("source"), F.concat(F.lit("src"), (F.col("n_chars") % 20).cast("string"))
        ).alias("shelves"),
        F.when(tenth == 0, F.lit(None)).when(tenth == 1, "not rated").otherwise(note).alias("marc908"),
    )


def id_lines(spark: SparkSession, folder: str) -> DataFrame:
    i = F.col("doc_id")
    text = i.cast("string")
    line = (
        F.when(i % 11 == 0, "")
        .when(i % 7 == 0, F.concat(F.lit("# "), text))
        .when(i % 5 == 0, F.concat(F.lit(" "), text))
        .otherwise(text)
    )
    times = F.when(i % 3 == 0, 2).otherwise(1)
    d = documents(spark, folder, "doc_id").select(line.alias("value"), times.alias("times"))
    return d.select("value", F.explode(F.sequence(F.lit(1), "times"))).select("value")


def fetched(spark: SparkSession, folder: str) -> DataFrame:
    d = documents(spark, folder, "doc_id", "text")
    attempts = F.array(
        *[
            F.struct(
                F.lit("text" if p < FIRST_ZIP else "zip").alias("kind"),
                F.lit(p).alias("priority"),
                F.lit(0).alias("member_idx"),
                F.concat(F.col("doc_id").cast("string"), F.lit(".TXT")).alias("member"),
                F.when((F.col("doc_id") * 7 + p * 3) % 5 == 0, 200).otherwise(404).alias("status"),
            )
            for p in range(PATTERNS)
        ]
    )
    return d.select(
        F.col("doc_id").cast("string").alias("book_id"), F.inline(attempts), F.col("text").alias("body")
    )


def fetched_members(spark: SparkSession, folder: str) -> DataFrame:
    """Like ``fetched``, with three members per archive, and bodies only where an address answered.

    The first member is no text file; of every third id the second one lacks the marker.
    """
    member = F.when(F.col("kind") == "zip", F.array(*map(F.lit, range(3)))).otherwise(F.array(F.lit(None).cast("int")))
    rows = fetched(spark, folder).drop("member_idx", "member").select("*", F.explode(member).alias("member_idx"))
    index, number = F.col("member_idx"), F.col("book_id").cast("bigint")
    suffix = F.when(index == 0, ".md").otherwise(".Txt")
    body = (
        F.when((index == 1) & (number % 3 == 0), F.replace("body", F.lit(MARKER), F.lit("-")))
        .when(index.isNotNull(), F.concat("body", F.lit(" member "), index.cast("string")))
        .otherwise(F.col("body"))
    )
    return rows.withColumns(
        {"member": F.concat("book_id", F.lit("/"), index.cast("string"), suffix), "body": F.when(F.col("status") == 200, body)}
    )


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Documents wrapped in the markup that cleaning removes, in eight ways."""
    text = F.col("text")
    first = F.substring_index(text, "\n", 1)
    rest = F.substr(text, F.length(first) + 1)

    def around(before: str, after: str = "") -> Column:
        return F.concat(F.lit(before), text, F.lit(after))

    def inside(middle: str, before: str = "") -> Column:
        return F.concat(F.lit(before), first, F.lit(middle), rest)

    ways = [
        around(START, END),
        around(TIGHT_START, TIGHT_END),
        around(BARE_START),
        around(LICENSE),
        inside(BRACKETS),
        around(NOTE),
        around(CONTENTS),
        inside(BLANKS, SHORT),
    ]
    way = F.col("doc_id") % len(ways)
    wrapped = F.when(way == 0, ways[0])
    for i, expression in enumerate(ways[1:], 1):
        wrapped = wrapped.when(way == i, expression)
    return texts(spark, folder).select("doc_id", wrapped.alias("text"))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a table of binary files: bad bytes, all line ends, blank and unreadable ones."""
    d = texts(spark, folder)
    line = F.lit("\n").cast("binary")
    bad = F.concat(F.unhex(F.lit("FF")), F.col("text").cast("binary"), F.unhex(F.lit("C328")), line)
    content = (
        F.when(F.col("doc_id") % 9 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n")).cast("binary"))
        .when(F.col("doc_id") % 9 == 1, F.replace("text", F.lit("\n"), F.lit("\r")).cast("binary"))
        .when(F.col("doc_id") % 9 == 2, bad)
        .when(F.col("doc_id") % 9 == 3, F.lit(" \n\t ").cast("binary"))
        .when(F.col("doc_id") % 9 != 4, F.col("text").cast("binary"))
    )
    return d.select(F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), content.alias("content"))


def catalog_documents(spark: SparkSession, folder: str, nested: bool = False) -> DataFrame:
    """RDF/XML documents as text, each with up to 50 books: ``(part, value)``.

    ``nested`` puts the languages of odd entries two elements deeper.
    """

    def element(tag: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{tag}>"), value, F.lit(f"</{tag}>"))

    def described(tag: str, value: Column) -> Column:
        return element(tag, element("rdf:Description", element("rdf:value", value)))

    number = F.col("book_id").cast("bigint")
    # Odd entries: an empty first language, a padded one, a padded category.
    language = F.when(number % 17 == 0, F.lit("")).when(number % 17 == 1, F.concat(F.lit(" "), "lang")).otherwise(F.col("lang"))
    deeper = element("dcterms:hasFormat", element("pgterms:file", described("dcterms:language", language)))
    book = F.concat(
        F.when(F.lit(nested) & (number % 2 == 1), deeper).otherwise(described("dcterms:language", language)),
        F.when(number % 17 == 0, described("dcterms:language", F.lit("en"))).otherwise(F.lit("")),
        F.array_join(F.transform("shelves", lambda s: described("pgterms:bookshelf", F.when(number % 19 == 0, F.concat(s, F.lit(" "))).otherwise(s))), ""),
        element("pgterms:marc908", F.concat(F.coalesce(F.concat("marc908", F.lit(" ")), F.lit("")), F.lit("#"), "book_id")),
    )
    root = (
        '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"'
        ' xmlns:pgterms="http://www.gutenberg.org/2009/pgterms/"'
        ' xmlns:dcterms="http://purl.org/dc/terms/">'
    )
    part = F.floor(F.col("book_id").cast("bigint") / 50).cast("bigint").alias("part")
    return (
        ebooks(spark, folder)
        .groupBy(part)
        .agg(F.array_join(F.collect_list(element("pgterms:ebook", book)), "").alias("books"))
        .select("part", F.concat(F.lit(root), "books", F.lit("</rdf:RDF>")).alias("value"))
    )


def _zipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        payloads = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("about.md", text)
                archive.writestr(f"{doc_id}.TXT", text)
            whole = buffer.getvalue()
            payloads.append(whole[: len(whole) // 2] if doc_id % 10 == 3 else whole)
        yield pd.DataFrame(
            {"book_id": batch["doc_id"].astype(str), "priority": FIRST_ZIP, "content": payloads}
        )


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a ZIP payload; one in ten is damaged."""
    return texts(spark, folder).mapInPandas(_zipped, "book_id string, priority int, content binary")
