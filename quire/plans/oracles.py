"""The same questions as ANSI SQL for an independent engine (DuckDB dialect).

Written separately from the Spark expressions: positions instead of splits, list functions
instead of line regexes, row numbers over the whole table instead of range sums.
"""

from __future__ import annotations

from quire.fixed_values import (
    FRONT_WORDS,
    TEXT_ADDRESSES,
    WHITESPACE,
    ZIP_ADDRESSES,
)
from quire.plans import views

ORACLES: dict[str, str] = {}


def _s(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def _values(names) -> str:
    return ", ".join(f"({_s(n)})" for n in names)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# --- catalog ---

EBOOKS = """ebooks AS (
  SELECT CAST(doc_id AS VARCHAR) AS book_id, lang,
         [source, 'src' || CAST(n_chars % 20 AS VARCHAR)] AS shelves,
         CASE WHEN doc_id % 10 = 0 THEN NULL
              WHEN doc_id % 10 = 1 THEN 'not rated'
              ELSE 'Reading ease score: ' || CAST(n_chars % 105 AS VARCHAR) || '.7 (grade)' END AS marc908
  FROM documents)"""
CURATED = f"curated AS (SELECT * FROM (VALUES {_values(views.CURATED)}) AS t(shelf))"
_BAND = """CASE WHEN score IS NULL THEN 'unknown'
  WHEN score <= 30 THEN '0-30' WHEN score <= 50 THEN '31-50' WHEN score <= 60 THEN '51-60'
  WHEN score <= 70 THEN '61-70' WHEN score <= 80 THEN '71-80' WHEN score <= 90 THEN '81-90'
  ELSE '91-100' END"""
SCORED = f"""scored AS (
  SELECT *, {_BAND} AS band FROM (
    SELECT *, CAST(nullif(regexp_extract(marc908, '[0-9]+'), '') AS DOUBLE) AS score FROM ebooks))"""
TAGS = """tags AS (SELECT book_id, lang, unnest(shelves) AS shelf FROM ebooks)"""
QUALIFIED = """qualified AS (
  SELECT * FROM scored WHERE lang = 'en' AND score > 80
    AND book_id IN (SELECT book_id FROM tags JOIN curated USING (shelf)))"""
_Q = _with(EBOOKS, CURATED, SCORED, TAGS, QUALIFIED)

ORACLES["catalog_shelf_counts"] = _with(EBOOKS, TAGS) + (
    "SELECT shelf, count(*) AS n FROM tags WHERE lang = 'en' GROUP BY shelf"
)
ORACLES["catalog_distinct_shelves"] = _with(EBOOKS, TAGS) + (
    "SELECT count(DISTINCT shelf) AS n_shelves FROM tags WHERE lang = 'en'"
)
ORACLES["catalog_first_shelves"] = _with(EBOOKS, TAGS) + (
    "SELECT shelf, count(*) AS n FROM tags WHERE lang = 'en' GROUP BY shelf ORDER BY shelf LIMIT 10"
)
ORACLES["catalog_english_total"] = "SELECT count(*) AS n_books FROM documents WHERE lang = 'en'"
ORACLES["catalog_books_per_shelf"] = _with(EBOOKS, CURATED, TAGS) + (
    "SELECT c.shelf, count(DISTINCT t.book_id) AS n_books FROM curated c "
    "LEFT JOIN tags t ON t.shelf = c.shelf AND t.lang = 'en' GROUP BY c.shelf"
)
ORACLES["catalog_score_extract"] = _with(EBOOKS, SCORED) + (
    "SELECT book_id, score, band, "
    r"CAST(nullif(regexp_extract(marc908, '[0-9]+(\.[0-9]+)?'), '') AS DOUBLE) AS exact_score FROM scored"
)
ORACLES["catalog_score_histogram"] = _with(EBOOKS, CURATED, SCORED, TAGS) + (
    "SELECT b.band, count(s.book_id) AS n_books FROM (VALUES ('0-30'), ('31-50'), ('51-60'), ('61-70'), "
    "('71-80'), ('81-90'), ('91-100'), ('unknown')) AS b(band) LEFT JOIN (SELECT * FROM scored WHERE lang = 'en' "
    "AND book_id IN (SELECT book_id FROM tags JOIN curated USING (shelf))) s ON s.band = b.band GROUP BY b.band"
)
ORACLES["catalog_qualified_books"] = _Q + (
    "SELECT book_id, score, band, (SELECT string_agg(DISTINCT t.shelf, '|' ORDER BY t.shelf) FROM tags t "
    "JOIN curated c ON c.shelf = t.shelf WHERE t.book_id = q.book_id) AS shelves FROM qualified q"
)
ORACLES["catalog_qualified_ids"] = _Q + "SELECT DISTINCT book_id FROM qualified"
ORACLES["catalog_qualified_by_band"] = _Q + (
    "SELECT band, count(*) AS n_books FROM qualified GROUP BY ROLLUP (band)"
)
ORACLES["catalog_qualified_by_shelf"] = _Q + (
    "SELECT c.shelf, count(DISTINCT q.book_id) AS n_books FROM curated c LEFT JOIN "
    "(tags t JOIN qualified q ON q.book_id = t.book_id) ON t.shelf = c.shelf GROUP BY c.shelf"
)
ORACLES["catalog_top_ids_per_band"] = _Q + (
    "SELECT band, book_id, position FROM (SELECT band, book_id, row_number() OVER (PARTITION BY band "
    "ORDER BY CAST(book_id AS BIGINT)) AS position FROM qualified) WHERE position <= 20"
)
ORACLES["catalog_key_from_path"] = r"""
SELECT page_id, CASE WHEN regexp_matches(name, '^[0-9]+\?page') THEN regexp_extract(name, '^([0-9]+)', 1)
                     ELSE regexp_replace(name, '^(.+)\.[^.]*$', '\1') END AS file_key
FROM (SELECT page_id, string_split(url, '/')[-1] AS name FROM pages)"""
ORACLES["catalog_xml_read"] = _with(EBOOKS) + """
SELECT book_id AS entry, CASE CAST(book_id AS BIGINT) % 17 WHEN 0 THEN NULL WHEN 1 THEN ' ' || lang ELSE lang END AS lang,
  CASE WHEN CAST(book_id AS BIGINT) % 19 = 0 THEN array_to_string(shelves, ' |') || ' '
    ELSE array_to_string(shelves, '|') END AS shelves,
  coalesce(marc908, '') AS marc908 FROM ebooks"""
ORACLES["catalog_xml_nested"] = ORACLES["catalog_xml_read"]

# --- acquisition ---

ID_LIST = """lines AS (
  SELECT CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 7 = 0 THEN '# ' || doc_id
              WHEN doc_id % 5 = 0 THEN ' ' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS line
  FROM documents)"""
_ID_LIST = _with(ID_LIST) + (
    "SELECT DISTINCT trim(line) AS book_id FROM lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')"
)
ORACLES["acquire_id_list"] = _ID_LIST
ORACLES["acquire_id_file"] = _ID_LIST
ORACLES["acquire_ids_written"] = _ID_LIST
ORACLES["acquire_documents_written"] = (
    "SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM documents"
)
_ADDRESSES = ", ".join(
    f"({i}, '{'text' if i < len(TEXT_ADDRESSES) else 'zip'}', {_s(a)})"
    for i, a in enumerate(TEXT_ADDRESSES + ZIP_ADDRESSES)
)
ORACLES["acquire_candidates"] = f"""
SELECT CAST(doc_id AS VARCHAR) AS book_id, priority, kind,
       replace(address, '{{id}}', CAST(doc_id AS VARCHAR)) AS url
FROM documents, (VALUES {_ADDRESSES}) AS p(priority, kind, address)"""
ORACLES["acquire_resume"] = (
    "SELECT CAST(doc_id AS VARCHAR) AS book_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
VALID = f"""valid AS (
  SELECT doc_id, priority, text FROM documents, range({views.PATTERNS}) AS p(priority)
  WHERE (doc_id * 7 + priority * 3) % 5 = 0 AND contains(text, {_s(views.MARKER)}))"""
ORACLES["acquire_first_valid"] = _with(VALID) + (
    f"SELECT CAST(doc_id AS VARCHAR) AS book_id, CASE WHEN priority < {views.FIRST_ZIP} THEN 'text' ELSE 'zip' END AS kind, "
    "CAST(priority AS INTEGER) AS priority, 0 AS member_idx, length(text) AS n_chars, md5(text) AS text_md5 "
    "FROM valid QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY priority) = 1"
)
ORACLES["acquire_first_valid_stored"] = f"""
WITH attempts AS (
  SELECT doc_id, priority, CASE WHEN priority < {views.FIRST_ZIP} THEN 'text' ELSE 'zip' END AS kind, member_idx,
    CASE WHEN member_idx = 1 AND doc_id % 3 = 0 THEN replace(text, {_s(views.MARKER)}, '-')
         WHEN member_idx IS NOT NULL THEN text || ' member ' || member_idx ELSE text END AS body
  FROM documents, range({views.PATTERNS}) AS p(priority), (VALUES (NULL), (0), (1), (2)) AS m(member_idx)
  WHERE (member_idx IS NULL) = (priority < {views.FIRST_ZIP}) AND (doc_id * 7 + priority * 3) % 5 = 0)
SELECT CAST(doc_id AS VARCHAR) AS book_id, kind, CAST(priority AS INTEGER) AS priority, member_idx,
  length(body) AS n_chars, md5(body) AS text_md5
FROM attempts WHERE contains(body, {_s(views.MARKER)}) AND (member_idx IS NULL OR member_idx > 0)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY priority, member_idx) = 1"""
ORACLES["acquire_resume_stream"] = ORACLES["acquire_resume"]
ORACLES["acquire_failures"] = _with(VALID) + (
    "SELECT CAST(doc_id AS VARCHAR) AS book_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM valid)"
)
ORACLES["acquire_report"] = _with(VALID) + (
    "SELECT CASE WHEN doc_id IN (SELECT doc_id FROM valid) THEN 'downloaded' ELSE 'failed' END AS outcome, "
    "count(*) AS n_ids FROM documents GROUP BY 1"
)
ORACLES["acquire_zip_members"] = (
    f"SELECT CAST(doc_id AS VARCHAR) AS book_id, {views.FIRST_ZIP} AS priority, 1 AS member_idx, "
    "doc_id || '.TXT' AS member, length(text) AS n_chars, md5(text) AS text_md5 "
    "FROM documents WHERE doc_id % 10 <> 3"
)

# --- cleaning ---

_FIRST = "split_part(text, chr(10), 1)"
_REST = f"substr(text, length({_FIRST}) + 1)"
RAW = f"""raw AS (
  SELECT doc_id, CASE doc_id % 8
    WHEN 0 THEN {_s(views.START)} || text || {_s(views.END)}
    WHEN 1 THEN {_s(views.TIGHT_START)} || text || {_s(views.TIGHT_END)}
    WHEN 2 THEN {_s(views.BARE_START)} || text
    WHEN 3 THEN {_s(views.LICENSE)} || text
    WHEN 4 THEN {_FIRST} || {_s(views.BRACKETS)} || {_REST}
    WHEN 5 THEN {_s(views.NOTE)} || text
    WHEN 6 THEN {_s(views.CONTENTS)} || text
    ELSE {_s(views.SHORT)} || {_FIRST} || {_s(views.BLANKS)} || {_REST} END AS text
  FROM documents)"""

_W = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = _s(WHITESPACE)
_START = [rf"(?i)\*\*\*{gap}START OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*" for gap in (" ", "")]
_END = [rf"(?i)\*\*\*{gap}END OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*" for gap in (" ", "")]


def _before_end(source: str, name: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(text, '(?s)\\A(.*?){p}', 1)" for p in _END
    )
    return f"{name} AS (SELECT *, CASE {cases} ELSE text END AS body FROM {source})"


def _front(source: str, name: str) -> str:
    words = " AND ".join(f"NOT contains(lower(l), {_s(w)})" for w in FRONT_WORDS)
    return (
        f"{name} AS (SELECT *, coalesce(strpos(text, [l FOR l IN string_split(text, chr(10))[1:51] "
        f"IF trim(l, {_STRIP}) <> '' AND {words}][1]), 1) AS front FROM {source})"
    )


def _between(source: str, name: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches(text, '{p}') THEN regexp_extract(body, '(?s)\\A.*?{p}(.*)\\z', 1)" for p in _START
    )
    return f"{name} AS (SELECT doc_id, CASE {cases} ELSE substr(body, front) END AS text FROM {source})"


def _replace(source: str, name: str, *rules: tuple[str, str]) -> str:
    expression = "text"
    for pattern, by in rules:
        expression = f"regexp_replace({expression}, {_s(pattern)}, {_s(by)}, 'g')"
    return f"{name} AS (SELECT doc_id, {expression} AS text FROM {source})"


_BRACKETS = (
    (r"(?i)\[Illustration[^\]]*\]", ""),
    (r"(?s)\[Sidenote:.*?\]", ""),
    (r"(?is)\[Footnote.*?\]", ""),
)
_NOTES = ((r"(?is)Transcriber['s]* Note[s]*:.*?(\n\n|\z)", r"\1"),)
_CONTENTS = (
    (
        rf"(?i)\n{_W}*(?:Contents|Table of Contents){_W}*\n(?:[^\n]*\n){{1,50}}?(\n\n[A-Z]|\nCHAPTER)",
        "\n\\1",
    ),
)
_BLANKS = ((rf"\n{_W}*\n{_W}*\n({_W}*\n)+", "\n\n\n"),)


def _trimmed(source: str, name: str) -> str:
    lines = f"string_split(trim(text, {_STRIP}), chr(10))"
    return (
        f"{name}_i AS (SELECT doc_id, lines, "
        f"list_position([length(trim(l, {_STRIP})) >= 3 FOR l IN lines], true) AS i "
        f"FROM (SELECT doc_id, {lines} AS lines FROM {source})),\n"
        f"{name} AS (SELECT doc_id, CASE WHEN coalesce(i, 0) = 0 THEN '' "
        f"ELSE array_to_string(lines[i:], chr(10)) END AS text FROM {name}_i)"
    )


def _chain(source: str) -> list[str]:
    return [
        _before_end(source, "c1"),
        _front("c1", "c2"),
        _between("c2", "c3"),
        _replace("c3", "c4", *_BRACKETS, *_NOTES, *_CONTENTS, *_BLANKS),
        _trimmed("c4", "cleaned"),
    ]


_DIGEST = "length({0}) AS n_chars, md5({0}) AS text_md5"
_TEXT = "SELECT doc_id, " + _DIGEST.format("text") + " FROM "
GATED = """gated AS (
  SELECT doc_id, CASE WHEN length(text) < 1000 THEN 'skipped' ELSE 'success' END AS status,
         length(text) AS n_chars,
         CASE WHEN length(text) < 1000 THEN 'too short (' || length(text) || ' chars)' END AS message, text
  FROM cleaned)"""
_GATED_RAW = _with(RAW, *_chain("raw"), GATED)

ORACLES["clean_markers"] = _with(RAW, *_chain("raw")[:3]) + _TEXT + "c3"
ORACLES["clean_end_marker"] = (
    _with(RAW, _before_end("raw", "c1")) + "SELECT doc_id, " + _DIGEST.format("body") + " FROM c1"
)
ORACLES["clean_brackets"] = _with(RAW, _replace("raw", "c", *_BRACKETS)) + _TEXT + "c"
ORACLES["clean_notes"] = _with(RAW, _replace("raw", "c", *_NOTES)) + _TEXT + "c"
ORACLES["clean_contents"] = _with(RAW, _replace("raw", "c", *_CONTENTS)) + _TEXT + "c"
ORACLES["clean_whitespace"] = (
    _with(RAW, _replace("raw", "b", *_BLANKS), _trimmed("b", "c")) + _TEXT + "c"
)
ORACLES["clean_all_steps"] = _with(RAW, *_chain("raw")) + _TEXT + "cleaned"
ORACLES["clean_fallback_start"] = _with(RAW, _front("raw", "c")) + (
    f"SELECT doc_id, regexp_matches(text, '{_START[0]}') OR regexp_matches(text, '{_START[1]}') AS marked, "
    + _DIGEST.format("substr(text, front)")
    + " FROM c"
)
ORACLES["clean_gate"] = (
    _GATED_RAW + "SELECT doc_id, status, n_chars, message, md5(text) AS text_md5 FROM gated"
)
_FILES = """files AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE doc_id % 9
  WHEN 2 THEN text || '(' || chr(10) WHEN 3 THEN ' ' || chr(10) || chr(9) || ' ' WHEN 4 THEN NULL
  ELSE text END AS text FROM documents)"""
ORACLES["clean_files"] = _with(
    _FILES,
    *_chain("files"),
    """readable AS (
  SELECT doc_id, CASE WHEN f.text IS NOT NULL THEN c.text END AS text FROM cleaned c JOIN files f USING (doc_id))""",
) + """
SELECT doc_id, CASE WHEN text IS NULL THEN 'failed' WHEN length(text) < 300 THEN 'skipped' ELSE 'success' END AS status,
  length(text) AS n_chars, CASE WHEN text IS NULL THEN 'unreadable text'
    WHEN length(text) < 300 THEN 'too short (' || length(text) || ' chars)' END AS message, md5(text) AS text_md5
FROM readable"""
ORACLES["files_read"] = _with(
    _FILES,
    """sizes AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE doc_id % 9
  WHEN 0 THEN strlen(replace(text, chr(10), chr(13) || chr(10))) WHEN 2 THEN strlen(text) + 4 WHEN 3 THEN 4
  ELSE strlen(text) END AS n_bytes FROM documents WHERE doc_id % 9 <> 4)""",
    *_chain("files"),
    """readable AS (SELECT doc_id, n_bytes, CASE WHEN n_bytes <= 2000 THEN c.text END AS text
  FROM cleaned c JOIN sizes s USING (doc_id) WHERE n_bytes IS NOT NULL)""",
) + """
SELECT doc_id, CASE WHEN text IS NULL THEN 'failed' WHEN length(text) < 300 THEN 'skipped' ELSE 'success' END AS status,
  length(text) AS n_chars, CASE WHEN text IS NULL THEN 'too large (' || n_bytes || ' bytes)'
    WHEN length(text) < 300 THEN 'too short (' || length(text) || ' chars)' END AS message, md5(text) AS text_md5
FROM readable"""
ORACLES["clean_stories"] = _with(
    _FILES, f"stripped AS (SELECT doc_id, trim(text, {_STRIP}) AS text FROM files WHERE trim(text, {_STRIP}) <> '')"
) + "SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM stripped"
ORACLES["clean_report"] = _GATED_RAW + (
    "SELECT status, count(*) AS n_docs, CAST(sum(n_chars) FILTER (status = 'success') AS BIGINT) AS n_chars "
    "FROM gated GROUP BY status"
)
ORACLES["clean_rejected"] = _GATED_RAW + (
    "SELECT doc_id, status, message FROM gated WHERE status <> 'success'"
)
ORACLES["clean_written"] = _GATED_RAW + _TEXT + "gated WHERE status = 'success'"
ORACLES["clean_replaced"] = ORACLES["clean_written"]
ORACLES["clean_documents_stream"] = _with(*_chain("documents"), GATED) + (
    "SELECT doc_id, status, n_chars, md5(text) AS text_md5 FROM gated"
)

# --- split ---


def _split(source: str, columns: str = "*", ratio: float = 0.9, seed: int = 42) -> str:
    order = f"md5('{seed}:' || CAST(doc_id AS VARCHAR)), doc_id"
    return (
        f"parts AS (SELECT {columns}, CASE WHEN row_number() OVER (ORDER BY {order}) "
        f"<= floor((SELECT count(*) FROM {source}) * CAST({ratio} AS DOUBLE)) "
        f"THEN 'train' ELSE 'val' END AS split FROM {source})"
    )


ORACLES["split_exact"] = _with(_split("documents", "doc_id")) + "SELECT * FROM parts"
ORACLES["split_sizes"] = _with(_split("documents", "doc_id", 0.29, 7)) + (
    "SELECT split, count(*) AS n_docs FROM parts GROUP BY split"
)
ORACLES["split_attached"] = _with(_split("documents")) + (
    "SELECT split, lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars "
    "FROM parts GROUP BY split, lang"
)
_REPEATED_SPLIT = """WITH keyed AS (
  SELECT CASE WHEN doc_id % 13 <> 0 THEN CAST(doc_id % 40 AS VARCHAR) END AS doc_id, text FROM documents),
placed AS (SELECT *, count(*) OVER () AS total,
  row_number() OVER (ORDER BY md5(concat_ws(':', '42', doc_id)), md5('42:' || text)) AS place FROM keyed)
SELECT doc_id, CASE WHEN place <= floor(total * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'val' END AS split,
  length(text) AS n_chars, md5(text) AS text_md5 FROM placed"""
ORACLES["split_repeated_keys"] = _REPEATED_SPLIT
ORACLES["split_attached_repeated"] = _REPEATED_SPLIT
ORACLES["split_written"] = _with(_split("documents")) + (
    "SELECT split, doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM parts"
)

# --- tokens ---

_WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def _stories(source: str) -> str:
    return (
        f"stories AS (SELECT doc_id, trim(text, {_STRIP}) AS text FROM {source} "
        f"WHERE trim(text, {_STRIP}) <> '')"
    )


def _vocabulary(source: str) -> str:
    return f"""listed AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words FROM {source}),
vocabulary AS (
  SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) + 1 AS INTEGER) AS id
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM listed) GROUP BY token))"""


# One row per token of a story, the end of text (id 0) included; i counts from 0.
_IDS = """located AS (
  SELECT doc_id, token, i FROM (
    SELECT doc_id, unnest(words) AS token, unnest(range(len(words))) AS i FROM listed)),
ids AS (
  SELECT l.doc_id, l.i, v.id FROM located l JOIN vocabulary v ON v.token = l.token
  UNION ALL SELECT doc_id, len(words), 0 FROM listed)"""
_ID_TEXT = "md5(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY {0})) AS ids_md5"

_TOKENS = _with(_stories("documents"), _vocabulary("stories"), _IDS)
ORACLES["tokens_word"] = _TOKENS + (
    "SELECT doc_id, len(words) AS n_tokens, md5(array_to_string(words, ' ')) AS tokens_md5 FROM listed"
)
ORACLES["tokens_vocabulary"] = _TOKENS + "SELECT token, n, id FROM vocabulary"
ORACLES["tokens_word_ids"] = _TOKENS + (
    f"SELECT doc_id, count(*) AS n_tokens, {_ID_TEXT.format('i')} FROM ids GROUP BY doc_id"
)
ORACLES["tokens_word_ids_joined"] = ORACLES["tokens_word_ids"]
ORACLES["tokens_special_ids"] = _TOKENS + (
    "SELECT count(*) + 2 AS vocab_size, CAST(NULL AS INTEGER) AS bos_id, 0 AS eos_id, 0 AS pad_id FROM vocabulary"
)
ORACLES["tokens_bytes"] = _with(_stories("documents")) + (
    "SELECT doc_id, CAST(octet_length(encode(text)) + 3 AS BIGINT) AS n_tokens, "
    "md5(hex(encode(text)) || '0A1000A') AS ids_md5 FROM stories"
)

# --- packing ---

_PLACED = """placed AS (
  SELECT split, ids.doc_id, ids.id,
         row_number() OVER (PARTITION BY split ORDER BY CAST(ids.doc_id AS VARCHAR) || '.txt', i) - 1 AS pos
  FROM ids JOIN parts USING (doc_id))"""


def _chunks(length: int, overlap: int) -> str:
    stride = length - overlap
    return f"""sizes AS (SELECT split, count(*) AS total FROM placed GROUP BY split),
bounds AS (SELECT split, total,
  CASE WHEN total < {length} THEN 0 ELSE (total - {length}) // {stride} + 1 END AS full_chunks FROM sizes),
spread AS (
  SELECT split, id, pos, total, full_chunks, unnest(range(
    CASE WHEN pos < {length} THEN 0 ELSE (pos - {length}) // {stride} + 1 END, pos // {stride} + 1)) AS chunk_id
  FROM placed JOIN bounds USING (split)),
chunks AS (
  SELECT split, chunk_id, count(*) AS n_tokens, min_by(id, pos) AS first_id, max_by(id, pos) AS last_id,
         {_ID_TEXT.format('pos')}, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS id_text
  FROM spread
  WHERE chunk_id < full_chunks
     OR (chunk_id = full_chunks AND total - full_chunks * {stride} > {length} // 2)
  GROUP BY split, chunk_id)"""


_STREAM = [_stories("documents"), _vocabulary("stories"), _IDS, _split("stories", "doc_id"), _PLACED]
_CHUNK_COLUMNS = "SELECT split, chunk_id, n_tokens, first_id, last_id, ids_md5 FROM chunks"
ORACLES["pack_offsets"] = _with(*_STREAM) + (
    "SELECT split, doc_id, count(*) AS n_tokens, min(pos) AS \"offset\", "
    "CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS total FROM placed GROUP BY split, doc_id"
)
ORACLES["pack_chunks"] = _with(*_STREAM, _chunks(256, 32)) + _CHUNK_COLUMNS
ORACLES["pack_chunks_large"] = _with(*_STREAM, _chunks(1024, 128)) + _CHUNK_COLUMNS
_APPENDED = _PLACED.replace("ORDER BY ", "ORDER BY CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 0 END, ", 1)
ORACLES["pack_appended"] = _with(*_STREAM[:-1], _APPENDED, _chunks(256, 32)) + _CHUNK_COLUMNS
ORACLES["pack_repeated_keys"] = _with(
    """keyed AS (SELECT doc_id AS number, CASE WHEN doc_id % 13 <> 0 THEN CAST(doc_id % 40 AS VARCHAR) END AS name, text
  FROM documents)""",
    f"""stories AS (SELECT number AS doc_id, name, trim(text, {_STRIP}) AS text FROM keyed
  WHERE trim(text, {_STRIP}) <> '')""",
    _vocabulary("stories"),
    _IDS,
    """placed AS (
  SELECT 'all' AS split, ids.id, row_number() OVER (
    ORDER BY name || '.txt' NULLS FIRST, md5(text), ids.doc_id, i) - 1 AS pos
  FROM ids JOIN stories USING (doc_id))""",
    _chunks(256, 32),
) + _CHUNK_COLUMNS
ORACLES["pack_report"] = _with(*_STREAM, _chunks(256, 32)) + (
    "SELECT split, n_docs, n_chunks, n_tokens FROM "
    "(SELECT split, count(*) AS n_docs FROM parts GROUP BY split) JOIN "
    "(SELECT split, count(*) AS n_chunks, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM chunks GROUP BY split) "
    "USING (split)"
)
_WRITTEN = _with(*_STREAM, _chunks(256, 32)) + "SELECT CASE split WHEN 'val' THEN 'validation' ELSE split END AS split, "
ORACLES["pack_written"] = _WRITTEN + (
    "chunk_id, n_tokens, first_id, last_id, ids_md5, ids_md5 AS labels_md5 FROM chunks"
)
ORACLES["pack_counts"] = _WRITTEN + "count(*) AS n_chunks FROM chunks GROUP BY 1"

# --- training order ---

_PLAN = """ordered AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || CAST(chunk_id AS VARCHAR)), chunk_id) - 1 AS rank,
         count(*) OVER (PARTITION BY split) AS n FROM chunks),
plan AS (SELECT *, rank // 8 AS batch_id, rank // 16 AS step_id FROM ordered WHERE rank < ceil(n * CAST(0.5 AS DOUBLE)))"""
_EXPORT = _with(*_STREAM, _chunks(256, 32), _PLAN)
ORACLES["export_epoch_plan"] = _EXPORT + (
    "SELECT split, chunk_id, n_tokens, rank, batch_id, step_id FROM plan"
)
ORACLES["export_collate"] = _EXPORT + """
SELECT split, chunk_id, batch_id, md5(id_text || repeat(' 0', missing)) AS ids_md5,
       md5('1' || repeat(' 1', CAST(n_tokens - 1 AS BIGINT)) || repeat(' 0', missing)) AS mask_md5,
       md5(id_text || repeat(' -100', missing)) AS labels_md5
FROM (SELECT *, CAST(max(n_tokens) OVER (PARTITION BY split, batch_id) - n_tokens AS BIGINT) AS missing FROM plan)"""

# --- all together ---

ORACLES["corpus_packed"] = (
    _with(
        "english AS (SELECT doc_id, text FROM documents WHERE lang = 'en')",
        *_chain("english"),
        GATED,
        "kept AS (SELECT doc_id, text FROM gated WHERE status = 'success')",
        _stories("kept"),
        _vocabulary("stories"),
        _IDS,
        _split("stories", "doc_id"),
        _PLACED,
        _chunks(256, 32),
    )
    + _CHUNK_COLUMNS
)

