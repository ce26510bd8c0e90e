"""License scan: MinHash over overlapping text windows retrieves templates, exact containment verifies.

Texts are five-word shingles. A template with ``n`` shingles has the window step ``s``, the power of
two from ``n`` on; windows hold ``2 s`` shingles and start at every multiple of ``s``, so wherever a template
stands, one window holds all of it. If a window holds a share ``c`` of a template, their Jaccard
similarity is at least ``c n / (2 s + (1 - c) n)``, which is 0.19 or more at ``c = 0.8`` (n just above a
power of two) and 0.36 where ``n = s``. ``BANDS`` bands of one row each miss it with probability
``(1 - 0.19) ** 48 < 0.0001``.

A window can only collide with a template in a band if it holds the template's smallest shingle of
that band. So the windows around such anchor shingles are all that have to be hashed; the rest can
not collide, and most documents have none. Collisions are verified: a document matches if a window
holds at least 0.8 of the template's shingles.

All of it is built-in functions on the rows where they lie; only matches are shuffled. Templates are
taken in blocks of ``TEMPLATE_BLOCK``, so what each task gets is bounded.

Defined cases: null, empty and short texts match nothing. Templates with fewer than five words or a
null name are ignored. Rows with equal ``doc_id`` and text are one document; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 48
TEMPLATE_BLOCK = 500

# Notices as public licenses word them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ),
    (
        "Apache-2.0-notice",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "BSD-redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
)


def notices(spark: SparkSession) -> DataFrame:
    """``(license, text)`` of the built-in templates."""
    return spark.createDataFrame(list(NOTICES), "license string, text string")


def _once(value: Column) -> Column:
    """Keep a value from being computed again for each use or filter above it."""
    return F.explode(F.array(value))


def with_shingles(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``shingles``, the hashes of its five-word shingles in order."""
    kept = [c for c in df.columns if c != text]
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    cut = df.select(*kept, _once(words).alias("_words"))
    n = F.size("_words")
    hashes = F.transform(
        F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(SHINGLE)])
    )
    none = F.array().cast("array<bigint>")
    return cut.select(*kept, _once(F.when(n >= SHINGLE, hashes).otherwise(none)).alias("shingles"))


def _lowest(shingles: Column, band: int) -> Column:
    """The smallest hash of a band, with its shingle."""
    return F.array_min(F.transform(shingles, lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("low"), x.alias("shingle"))))


def prepared(templates: DataFrame) -> DataFrame:
    """``(license, own, step, bands)``: distinct shingles, window step, smallest shingle per band."""
    named = templates.filter("license is not null").select("license", F.col("text").cast("string").alias("text"))
    own = with_shingles(named.distinct()).select("license", F.array_distinct("shingles").alias("own")).filter("size(own) > 0")
    bands = F.array(*[_lowest(F.col("own"), b) for b in range(BANDS)])
    return own.select("license", "own", _power(F.size("own")).alias("step"), bands.alias("bands"))


def _power(n: Column) -> Column:
    """The smallest power of two that is at least ``n``."""
    return F.pow(F.lit(2.0), F.ceil(F.log2(n.cast("double")))).cast("int")


def _blocks(templates: DataFrame) -> Iterator[list]:
    rows: list = []
    for row in prepared(templates).toLocalIterator():
        rows.append(row)
        if len(rows) == TEMPLATE_BLOCK:
            yield rows
            rows = []
    if rows:
        yield rows


def _matches(shingled: DataFrame, block: list) -> DataFrame:
    spark = shingled.sparkSession
    templates = spark.createDataFrame(
        [(r.license, r.own, r.step, [b.low for b in r.bands]) for r in block],
        "license string, own array<bigint>, step int, lows array<bigint>",
    )
    anchors = sorted({b.shingle for r in block for b in r.bands})
    found = F.array_compact(F.transform("shingles", lambda x, i: F.when(x.isin(anchors), i)))
    anchored = shingled.select("doc_id", "text_hash", "shingles", _once(found).alias("at")).filter("size(at) > 0")

    def windows(step: int) -> Column:
        near = F.flatten(F.transform("at", lambda i: F.array(F.floor(i / step), F.floor(i / step) - 1)))
        starts = F.filter(F.array_distinct(near), lambda k: k >= 0)
        cut = lambda k: F.slice("shingles", (k * step + 1).cast("int"), F.lit(2 * step))
        return F.transform(starts, lambda k: F.struct(F.lit(step).alias("step"), (k * step).alias("start"), cut(k).alias("window")))

    every = F.concat(*[windows(s) for s in sorted({r.step for r in block})])
    hashed = anchored.select("doc_id", "text_hash", F.inline(every)).select(
        "doc_id", "text_hash", "step", "start", "window",
        F.posexplode(F.array(*[_lowest(F.col("window"), b).low for b in range(BANDS)])).alias("band", "low"),
    )
    bands = templates.select("license", "own", "step", F.posexplode("lows").alias("band", "low"))
    collided = hashed.join(F.broadcast(bands), ["step", "band", "low"])
    shared = F.size(F.array_intersect("window", "own"))
    first = F.array_min(F.transform(F.array_intersect("window", "own"), lambda x: F.array_position("window", x)))
    return collided.filter(shared >= F.size("own") * CONTAINMENT).select(
        "doc_id", "text_hash", "license",
        (shared / F.size("own")).alias("containment"),
        (F.col("start") + first - 1).cast("bigint").alias("first_word"),
    )


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, license, containment, first_word)``, a row per document and license found in it.

    ``containment`` is the best of any window; ``first_word`` is where the first match starts.
    """
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    shingled = with_shingles(narrow)
    found = [_matches(shingled, block) for block in _blocks(templates)]
    if not found:
        nothing = "doc_id, text_hash, '' as license, 0D as containment, 0L as first_word"
        return narrow.selectExpr(*nothing.split(", ")).limit(0)
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "text_hash", "license")
        .agg(F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
    )


def license_rows(docs: DataFrame) -> DataFrame:
    return scan(docs, notices(docs.sparkSession)).drop("text_hash")


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in NOTICES)
ORACLE = f"""
WITH templates(license, text) AS (VALUES {_VALUES}),
words AS (
  SELECT license AS name, NULL AS doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w
  FROM templates
  UNION ALL
  SELECT NULL, doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') FROM documents
), shingles AS (
  SELECT name, doc_id, i - 1 AS at, w[i:i + 4] AS s
  FROM words, unnest(generate_series(1, len(w) - 4)) AS u(i) WHERE len(w) >= 5
), own AS (SELECT DISTINCT name, s FROM shingles WHERE name IS NOT NULL),
sizes AS (SELECT name, count(*) AS n FROM own GROUP BY name)
SELECT d.doc_id, o.name AS license, count(DISTINCT d.s)::DOUBLE / z.n AS containment, min(d.at) AS first_word
FROM shingles d JOIN own o ON d.s = o.s JOIN sizes z ON z.name = o.name
WHERE d.name IS NULL GROUP BY d.doc_id, o.name, z.n HAVING count(DISTINCT d.s) >= 0.8 * z.n
"""
