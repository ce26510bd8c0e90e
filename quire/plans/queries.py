"""Registered queries: every operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.fixed_values import SEED, TRAIN_RATIO
from quire.functions import cleaning as C
from quire.functions.catalog import file_key
from quire.operators import acquisition, catalog, packing, splitting, subwords, tokens, training_order
from quire.operators import cleaning as gating
from quire.plans import views
from quire.plans.corpus import CorpusSettings, build_corpus
from quire.sinks import tables
from quire.sinks.packed_store import PackedStore
from quire.sinks.replaced import ReplacedTable
from quire.sinks.text_files import write_text_files
from quire.sources.catalog import read_catalog
from quire.sources.files import read_files
from quire.sources.ids import numeric_order, parse_ids, read_ids
from quire.sources.packed import read_packed, split_counts
from quire.sources.texts import decoded, file_name_key, zip_members
from quire.staging import fresh_path, stage
from quire.streaming.acquisition import follow_available, read_ids_stream, still_missing
from quire.streaming.cleaning import clean_available, read_documents_stream

# Chunk geometry for the given tables: small enough for a few hundred chunks at every scale.
LENGTH, OVERLAP = 256, 32
BATCH, ACCUMULATION = 8, 2
# Bytes a task reads, and the largest file that is taken: the given texts have files on both sides.
FILE_TASK, FILE_LIMIT = 1 << 20, 2_000
CORPUS = CorpusSettings(max_length=LENGTH, overlap=OVERLAP)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _digest(text: Column) -> list[Column]:
    return [F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("text_md5")]


def _joined(ids: Column) -> Column:
    return F.md5(F.array_join(ids.cast("array<string>"), " "))


# --- catalog ---


@query
def catalog_shelf_counts(spark, folder):
    return catalog.by_name(catalog.shelf_counts(views.ebooks(spark, folder)))


@query
def catalog_distinct_shelves(spark, folder):
    return catalog.distinct_shelves(views.ebooks(spark, folder))


@query
def catalog_first_shelves(spark, folder):
    return catalog.first_shelves(views.ebooks(spark, folder))


@query
def catalog_english_total(spark, folder):
    return catalog.english_total(views.ebooks(spark, folder))


@query
def catalog_books_per_shelf(spark, folder):
    return catalog.by_name(catalog.books_per_shelf(views.ebooks(spark, folder), views.CURATED))


@query
def catalog_score_extract(spark, folder):
    exact = catalog.score(F.col("marc908"), exact=True).alias("exact_score")
    return catalog.scored(views.ebooks(spark, folder)).select("book_id", "score", "band", exact)


@query
def catalog_score_histogram(spark, folder):
    histogram = catalog.score_histogram(views.ebooks(spark, folder), views.CURATED)
    return histogram.orderBy("position").select("band", "n_books")


def _qualified(spark, folder):
    return catalog.qualified(views.ebooks(spark, folder), views.CURATED)


@query
def catalog_qualified_books(spark, folder):
    shelves = F.array_join(F.array_sort("shelves"), "|").alias("shelves")
    return _qualified(spark, folder).select("book_id", "score", "band", shelves)


@query
def catalog_qualified_ids(spark, folder):
    return catalog.union_of_bands(_qualified(spark, folder), ["81-90", "91-100"])


@query
def catalog_qualified_by_band(spark, folder):
    return catalog.qualified_per_band(_qualified(spark, folder))


@query
def catalog_qualified_by_shelf(spark, folder):
    return catalog.qualified_per_shelf(_qualified(spark, folder), views.CURATED)


@query
def catalog_top_ids_per_band(spark, folder):
    return catalog.top_ids(_qualified(spark, folder)).withColumn(
        "position", F.col("position").cast("bigint")
    )


@query
def catalog_key_from_path(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    name = F.element_at(F.split("url", "/"), -1)
    return pages.select("page_id", file_key(name, r"^(\d+)\?page").alias("file_key"))


def _catalog_read(spark, folder, nested):
    path = fresh_path(spark, "catalog")
    views.catalog_documents(spark, folder, nested).write.partitionBy("part").text(path)
    # A key per entry, as one written file holds many: the number that the entry's note ends with.
    shelves = F.array_join("shelves", "|").alias("shelves")
    entries = read_catalog(spark, path, "*")
    number = F.regexp_extract("marc908", r"#(\d+)$", 1).alias("entry")
    return entries.select(number, "lang", shelves, F.regexp_replace("marc908", r" ?#\d+$", "").alias("marc908"))


@query
def catalog_xml_read(spark, folder):
    return _catalog_read(spark, folder, nested=False)


@query
def catalog_xml_nested(spark, folder):
    return _catalog_read(spark, folder, nested=True)


# --- acquisition ---


@query
def acquire_id_list(spark, folder):
    return numeric_order(parse_ids(views.id_lines(spark, folder)))


@query
def acquire_id_file(spark, folder):
    path = fresh_path(spark, "ids")
    views.id_lines(spark, folder).write.text(path)
    return read_ids(spark, path)


@query
def acquire_ids_written(spark, folder):
    path = fresh_path(spark, "id-sink")
    tables.write_ids(parse_ids(views.id_lines(spark, folder)), path)
    return spark.read.text(path).select(F.col("value").alias("book_id"))


@query
def acquire_documents_written(spark, folder):
    path = fresh_path(spark, "raw")
    tables.write_documents(views.documents(spark, folder, "doc_id", "text"), path)
    return spark.read.parquet(path).select("doc_id", *_digest(F.col("text")))


def _ids(spark, folder, table="documents"):
    ids = spark.read.parquet(f"{folder}/{table}.parquet")
    return ids.select(F.col("doc_id").cast("string").alias("book_id"))


@query
def acquire_candidates(spark, folder):
    return acquisition.candidates(_ids(spark, folder))


@query
def acquire_resume(spark, folder):
    return acquisition.resume(_ids(spark, folder), _ids(spark, folder, "labels"))


def _resolved(spark, folder):
    return acquisition.first_valid(views.fetched(spark, folder), views.MARKER)


@query
def acquire_first_valid(spark, folder):
    found = _resolved(spark, folder)
    return found.select("book_id", "kind", "priority", "member_idx", *_digest(F.col("body")))


@query
def acquire_first_valid_stored(spark, folder):
    path = fresh_path(spark, "fetched")
    rows = views.fetched_members(spark, folder)
    rows.repartition(views.dealt(spark, folder)).write.parquet(path)
    found = acquisition.first_valid_stored(spark, path, views.MARKER)
    return found.select("book_id", "kind", "priority", "member_idx", *_digest(F.col("body")))


@query
def acquire_resume_stream(spark, folder):
    """Both tables arrive in two waves, with a restart between them."""
    asked, there = fresh_path(spark, "asked"), fresh_path(spark, "there")
    target, progress = fresh_path(spark, "known-ids"), fresh_path(spark, "progress")
    late = F.col("book_id").cast("bigint") % 2 == 1
    for wave in (~late, late):
        _ids(spark, folder).filter(wave).write.mode("append").parquet(asked)
        _ids(spark, folder, "labels").filter(~wave).write.mode("append").parquet(there)
        streams = read_ids_stream(spark, asked), read_ids_stream(spark, there)
        follow_available(*streams, target, progress).awaitTermination()
    return still_missing(spark, target)


@query
def acquire_failures(spark, folder):
    resolved = acquisition.valid(views.fetched(spark, folder), views.MARKER)
    return acquisition.failures(_ids(spark, folder), resolved)


@query
def acquire_report(spark, folder):
    resolved = acquisition.valid(views.fetched(spark, folder), views.MARKER)
    return acquisition.report(_ids(spark, folder), resolved.select("book_id").distinct())


@query
def acquire_zip_members(spark, folder):
    members = zip_members(views.archives(spark, folder))
    return members.select("book_id", "priority", "member_idx", "member", *_digest(F.col("body")))


# --- cleaning ---


def _cleaned_by(*steps):
    def run(spark, folder):
        df = views.raw(spark, folder)
        for step in steps:
            df = gating.evaluated_once(df, ["doc_id"], text=step(F.col("text")))
        return df.select("doc_id", *_digest(F.col("text")))

    return run


QUERIES["clean_markers"] = _cleaned_by(C.between_markers)
QUERIES["clean_end_marker"] = _cleaned_by(C.before_end_marker)
QUERIES["clean_brackets"] = _cleaned_by(C.drop_illustrations, C.drop_sidenotes, C.drop_footnotes)
QUERIES["clean_notes"] = _cleaned_by(C.drop_transcriber_notes)
QUERIES["clean_contents"] = _cleaned_by(C.drop_contents_block)
QUERIES["clean_whitespace"] = _cleaned_by(C.collapse_blank_runs, C.strip, C.drop_short_leading_lines)
QUERIES["clean_all_steps"] = _cleaned_by(C.clean)


@query
def clean_fallback_start(spark, folder):
    text = F.col("text")
    df = gating.evaluated_once(
        views.raw(spark, folder),
        ["doc_id"],
        marked=C.has_start_marker(text),
        text=C.from_first_content_line(text, text),
    )
    return df.select("doc_id", "marked", *_digest(F.col("text")))


@query
def clean_gate(spark, folder):
    gated = gating.gate(views.raw(spark, folder))
    return gated.select("doc_id", "status", "n_chars", "message", F.md5("text").alias("text_md5"))


@query
def clean_files(spark, folder):
    """Decoded binary files, stripped of blank ones, with the gate; some can not be read."""
    gated = gating.gate(decoded(views.files(spark, folder)), min_length=300)
    return gated.select("doc_id", "status", "n_chars", "message", F.md5("text").alias("text_md5"))


@query
def files_read(spark, folder):
    """Documents written to a real folder, one file each, and read back with an outcome per file."""
    path = fresh_path(spark, "files")
    contents = views.files(spark, folder).filter("content is not null")
    write_text_files(contents.withColumn("name", file_name_key(F.col("path"))), path, "name", "content")
    read = read_files(spark, path, task_bytes=FILE_TASK, max_bytes=FILE_LIMIT)
    gated = gating.gate(read, min_length=300, error="error")
    return gated.select("doc_id", "status", "n_chars", "message", F.md5("text").alias("text_md5"))


@query
def clean_stories(spark, folder):
    stories = tokens.stories(decoded(views.files(spark, folder)))
    return stories.select("doc_id", *_digest(F.col("text")))


@query
def clean_report(spark, folder):
    return gating.report(gating.gate(views.raw(spark, folder)))


@query
def clean_rejected(spark, folder):
    return gating.rejected(gating.gate(views.raw(spark, folder)))


@query
def clean_replaced(spark, folder):
    """Raw documents, then the cleaned ones in their place; the repeated batch changes nothing."""
    table, raw = ReplacedTable(spark, fresh_path(spark, "replaced")), views.raw(spark, folder)
    table.replace(raw.select("doc_id", "text"), "raw")
    table.replace(gating.accepted(gating.gate(raw)), "cleaned")
    table.replace(raw.select("doc_id", "text").filter("false"), "cleaned")
    return table.read().select("doc_id", *_digest(F.col("text")))


@query
def clean_documents_stream(spark, folder):
    schema = views.documents(spark, folder, "doc_id", "text").schema
    stream = read_documents_stream(spark, f"{folder}/documents.parquet", schema)
    path = fresh_path(spark, "cleaned-stream")
    clean_available(stream, path, fresh_path(spark, "progress")).awaitTermination()
    cleaned = spark.read.parquet(path)
    return cleaned.select("doc_id", "status", "n_chars", F.md5("text").alias("text_md5"))


@query
def clean_written(spark, folder):
    path = fresh_path(spark, "cleaned")
    tables.write_cleaned(gating.gate(views.raw(spark, folder)), path)
    return spark.read.parquet(path).select("doc_id", *_digest(F.col("text")))


# --- split ---


@query
def split_exact(spark, folder):
    return splitting.exact_split(views.documents(spark, folder, "doc_id"))


@query
def split_sizes(spark, folder):
    return splitting.split_sizes(
        splitting.exact_split(views.documents(spark, folder, "doc_id"), ratio=0.29, seed=7)
    )


@query
def split_attached(spark, folder):
    assignment = splitting.exact_split(views.documents(spark, folder, "doc_id"))
    docs = splitting.attach_split(views.documents(spark, folder, "doc_id", "lang", "n_chars"), assignment)
    return docs.groupBy("split", "lang").agg(
        F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars")
    )


def _repeated_split(spark, folder):
    return splitting.exact_split(views.repeated_keys(spark, folder), then_by=["text"])


@query
def split_repeated_keys(spark, folder):
    """Keys that repeat and are missing: no row is lost and the size is exact."""
    return _repeated_split(spark, folder).select("doc_id", "split", *_digest(F.col("text")))


@query
def split_attached_repeated(spark, folder):
    assignment = stage(_repeated_split(spark, folder).select("doc_id", "split"), "assignment")
    docs = splitting.attach_split(views.repeated_keys(spark, folder), assignment, then_by=["text"])
    return docs.select("doc_id", "split", *_digest(F.col("text")))


@query
def split_written(spark, folder):
    path = fresh_path(spark, "split")
    tables.write_split(splitting.exact_split(views.documents(spark, folder, "doc_id", "text")), path)
    return spark.read.parquet(path).select("split", "doc_id", *_digest(F.col("text")))


# --- tokens ---


@query
def tokens_word(spark, folder):
    df = tokens.stories(views.texts(spark, folder))
    df = gating.evaluated_once(df, ["doc_id"], words=tokens.words(F.col("text")))
    return df.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join("words", " ")).alias("tokens_md5"),
    )


@query
def tokens_vocabulary(spark, folder):
    return tokens.WordTokenizer.fit(tokens.stories(views.texts(spark, folder))).vocabulary


def _word_ids(spark, folder, **options):
    docs = stage(tokens.stories(views.texts(spark, folder)), "stories")
    return tokens.WordTokenizer.fit(docs, **options).transform(docs)


def _ids_digest(df, key="doc_id"):
    n = F.size("tokens").cast("bigint").alias("n_tokens")
    return df.select(key, n, _joined(F.col("tokens")).alias("ids_md5"))


@query
def tokens_word_ids(spark, folder):
    return _ids_digest(_word_ids(spark, folder))


@query
def tokens_word_ids_joined(spark, folder):
    return _ids_digest(_word_ids(spark, folder, shared_words=100))


@query
def tokens_special_ids(spark, folder):
    tokenizer = tokens.WordTokenizer.fit(tokens.stories(views.texts(spark, folder)))
    return tokens.special_ids(tokenizer, spark)


def _bytes_digest(df):
    digits = F.transform("tokens", lambda t: F.when(t < 16, F.lpad(F.hex(t), 2, "0")).otherwise(F.hex(t)))
    return df.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(digits, "")).alias("ids_md5"),
    )


@query
def tokens_bytes(spark, folder):
    docs = tokens.stories(views.texts(spark, folder))
    return _bytes_digest(tokens.ByteTokenizer().transform(docs))


def _subwords() -> subwords.SubwordTokenizer:
    import public_tokenizers  # only these queries need the vocabulary file

    return subwords.SubwordTokenizer(public_tokenizers.path("byte_bpe_50k.json"), eos="<|endoftext|>")


@query
def tokens_subword_ids(spark, folder):
    return _ids_digest(_subwords().transform(tokens.stories(views.texts(spark, folder))))


@query
def tokens_subword_counts(spark, folder):
    """How often, and in how many documents, each token of the vocabulary occurs."""
    tokenizer = _subwords()
    docs = stage(tokenizer.transform(tokens.stories(views.texts(spark, folder))), "tokens")
    return subwords.token_counts(docs, tokenizer.vocabulary(spark)).withColumn("token", F.hex("token"))


# --- packing ---


def _split_tokens(spark, folder):
    stories = stage(tokens.stories(views.texts(spark, folder)), "stories")
    split = splitting.exact_split(stories, ratio=TRAIN_RATIO, seed=SEED)
    return tokens.WordTokenizer.fit(split).transform(split)


def _packed(spark, folder, length=LENGTH, overlap=OVERLAP):
    return packing.pack(_split_tokens(spark, folder), length, overlap)


def _chunk_digest(packed, *more):
    ids = F.col("input_ids")
    return packed.select(
        "split",
        "chunk_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.get(ids, F.lit(0)).alias("first_id"),
        F.element_at(ids, -1).alias("last_id"),
        _joined(ids).alias("ids_md5"),
        *more,
    )


@query
def pack_offsets(spark, folder):
    table = stage(packing.counted(_split_tokens(spark, folder)), "tokens")
    return packing.offsets(table).select("split", "doc_id", "n_tokens", "offset", "total")


@query
def pack_chunks(spark, folder):
    return _chunk_digest(_packed(spark, folder))


@query
def pack_chunks_large(spark, folder):
    return _chunk_digest(_packed(spark, folder, 1024, 128))


@query
def pack_repeated_keys(spark, folder):
    stories = stage(tokens.stories(views.repeated_keys(spark, folder)), "stories")
    split = stories.withColumns({"split": F.lit("all"), "tie": F.md5("text")})
    tokenizer = tokens.WordTokenizer.fit(split, shared_words=100)
    return _chunk_digest(packing.pack(tokenizer.transform(split), LENGTH, OVERLAP, then_by=["tie"]))


@query
def pack_appended(spark, folder):
    """Two batches of stories packed one after the other, and a batch that is there already."""
    table = stage(_split_tokens(spark, folder), "tokens")
    store = PackedStore(spark, fresh_path(spark, "store"), LENGTH, OVERLAP)
    first, second = table.filter("doc_id % 3 <> 1"), table.filter("doc_id % 3 = 1")
    for batch, rows in (("first", first), ("second", second), ("first", first)):
        store.append(rows, batch)
    return _chunk_digest(store.read())


@query
def pack_report(spark, folder):
    table = stage(_split_tokens(spark, folder), "tokens")
    return packing.packing_report(table, packing.pack(table, LENGTH, OVERLAP))


@query
def pack_written(spark, folder):
    path = fresh_path(spark, "packed")
    packed = stage(_packed(spark, folder), "chunks")
    both = tables.bundle(packed.filter("split = 'train'"), packed.filter("split = 'val'"))
    tables.write_packed(both, path)
    written = read_packed(spark, path)
    return _chunk_digest(written, _joined(F.col("labels")).alias("labels_md5"))


@query
def pack_counts(spark, folder):
    path = fresh_path(spark, "packed")
    tables.write_packed(_packed(spark, folder), path, labels=False)
    return split_counts(read_packed(spark, path))


# --- training order ---


def _plan(packed):
    return training_order.epoch_plan(packed, batch=BATCH, accumulation=ACCUMULATION)


@query
def export_epoch_plan(spark, folder):
    plan = _plan(_packed(spark, folder))
    return plan.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))


@query
def export_collate(spark, folder):
    packed = stage(_packed(spark, folder), "packed")
    batches = training_order.collate(packed, _plan(packed), tokens.WordTokenizer.pad_id)
    return batches.select(
        "split",
        "chunk_id",
        "batch_id",
        _joined(F.col("input_ids")).alias("ids_md5"),
        _joined(F.col("attention_mask")).alias("mask_md5"),
        _joined(F.col("labels")).alias("labels_md5"),
    )


# --- all together ---


@query
def corpus_packed(spark, folder):
    """English documents, cleaned, gated, split, tokenized and packed."""
    documents = views.documents(spark, folder, "doc_id", "text", "lang")
    english = catalog.english(documents).repartition(spark.sparkContext.defaultParallelism)
    return _chunk_digest(build_corpus(english, CORPUS))
