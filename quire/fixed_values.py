"""Values that have to be exactly these for results to be right.

Everything in this module is data: word lists, lookup tables, marker patterns, address
templates and defaults fixed by the file formats and reports this library has to agree with.
"""

# --- Fixed values: catalog -------------------------------------------------------------

ENGLISH = "en"

# Namespaces prefixes as they appear in the catalog documents.
CATALOG_ROOT_TAG = "rdf:RDF"
CATALOG_FILE_GLOB = "*.rdf"
CATALOG_FILE_KEY = r"pg(\d+)\.rdf$"

# Curated categories.
CURATED_SHELVES = (
    # animals
    "Animal",
    "Animals-Domestic",
    "Animals-Wild",
    "Animals-Wild-Birds",
    "Animals-Wild-Insects",
    "Animals-Wild-Mammals",
    "Animals-Wild-Reptiles and Amphibians",
    # for children
    "Category: Children & Young Adult Reading",
    "Category: Mythology, Legends & Folklore",
    "Category: Nature/Gardening/Animals",
    "Child's Own Book of Great Musicians",
    "Children's Anthologies",
    "Children's Biography",
    "Children's Book Series",
    "Children's Fiction",
    "Children's History",
    "Children's Instructional Books",
    "Children's Literature",
    "Children's Myths, Fairy Tales, etc.",
    "Children's Picture Books",
    "Children's Verse",
    # stories and fantasy
    "Arthurian Legends",
    "Fantasy",
    "Folklore",
    "Mythology",
    # nature and seasons
    "Christmas",
    "School Stories",
    "Scouts",
    # magazines
    "Dew Drops",
    "Golden Days for Boys and Girls",
    "Harper's Young People",
    "Little Folks",
    "Our Young Folks",
    "St. Nicholas Magazine for Boys and Girls",
    "The Nursery",
)

# Reading-ease bands in report order: (name, inclusive upper bound). The band above the last
# bound is TOP_BAND and a book without a score is in NO_SCORE_BAND.
SCORE_BANDS = (
    ("0-30", 30),
    ("31-50", 50),
    ("51-60", 60),
    ("61-70", 70),
    ("71-80", 80),
    ("81-90", 90),
)
TOP_BAND = "91-100"
NO_SCORE_BAND = "unknown"
ALL_BANDS = ("0-30", "31-50", "51-60", "61-70", "71-80", "81-90", "91-100", "unknown")
MIN_SCORE = 80
IDS_PER_BAND = 20
FIRST_SHELVES = 10

# A score is read as its integer part only: "80.7" counts as 80.
SCORE_DIGITS = r"([0-9]+)"
SCORE_DECIMAL = r"([0-9]+(?:\.[0-9]+)?)"

# --- Fixed values: acquisition ---------------------------------------------------------

COMMENT_MARK = "#"
VALIDITY_MARK = "Project Gutenberg"
HTTP_OK = 200
TEXT_ADDRESSES = (
    "https://www.gutenberg.org/cache/epub/{id}/pg{id}.txt",
    "https://www.gutenberg.org/cache/epub/{id}/pg{id}.txt.utf8",
    "https://www.gutenberg.org/cache/epub/{id}/pg{id}.txt.utf-8",
    "https://www.gutenberg.org/files/{id}/{id}-0.txt",
    "https://www.gutenberg.org/files/{id}/{id}.txt",
    "https://www.gutenberg.org/files/{id}/{id}-8.txt",
)
ZIP_ADDRESSES = (
    "https://www.gutenberg.org/cache/epub/{id}/pg{id}.zip",
    "https://www.gutenberg.org/files/{id}/{id}.zip",
    "https://www.gutenberg.org/files/{id}/{id}-0.zip",
)

# --- Fixed values: cleaning ------------------------------------------------------------

# Whitespace as Unicode-aware text tools define it (29 characters, in code point order).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Book markers; of each pair the first form is preferred wherever it occurs.
# Flags: i+u Unicode case folding, d only "\n" ends a line, s dot matches "\n".
START_MARKERS = (
    r"(?iud)\*\*\* START OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK.*?\*\*\*",
    r"(?iud)\*\*\*START OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK.*?\*\*\*",
)
END_MARKERS = (
    r"(?iud)\*\*\* END OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK.*?\*\*\*",
    r"(?iud)\*\*\*END OF (?:THE |THIS )?PROJECT GUTENBERG EBOOK.*?\*\*\*",
)
MARKER_STARS = "***"

# Without a start marker: how many leading lines are inspected and what a line must not say.
FRONT_LINES = 51
FRONT_WORDS = ("project gutenberg", "ebook", "www.gutenberg", "license", "trademark")

ILLUSTRATION = r"(?iu)\[Illustration[^\]]*\]"
SIDENOTE = r"(?s)\[Sidenote:.*?\]"
FOOTNOTE = r"(?ius)\[Footnote.*?\]"
TRANSCRIBER_NOTE = r"(?ius)Transcriber['s]* Note[s]*:.*?(?=\n\n|\z)"
# Contents heading with the listing below it, from the line break before the heading on.
# {ws} is the class of WHITESPACE.
CONTENTS_BLOCK = (
    r"\n{ws}*+(?iu:Contents|Table of Contents){ws}*\n(?d:(?:.*?\n){{1,50}}?)"
    r"(?iu:(?=\n\n[A-Z]|\nCHAPTER))"
)
MAX_BLANK_RUN = "\n\n\n"
MIN_LENGTH = 1000
TOO_SHORT = "too short (%d chars)"
TEXT_FILE_GLOB = "*.txt"
TEXT_SUFFIX = ".txt"

# --- Fixed values: split, packing and training order -----------------------------------

TRAIN_RATIO = 0.9
SEED = 42
MAX_LENGTH = 1024
OVERLAP = 128
EPOCHS = 0.5
DEVICE_BATCH = 1
ACCUMULATION = 16
IGNORED_LABEL = -100
