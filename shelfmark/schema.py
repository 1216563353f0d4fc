"""Row types of the catalog and the fixed vocabularies it classifies with."""

from pyspark.sql import types as T

SCHEMA_VERSION = 2

FILES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("root", T.StringType()),
    T.StructField("rel_path", T.StringType()),
    T.StructField("top_folder", T.StringType()),
    T.StructField("filename", T.StringType()),
    T.StructField("ext", T.StringType()),
    T.StructField("fmt", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("rag_eligible", T.IntegerType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("mtime", T.DoubleType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("corpus", T.StringType()),
    T.StructField("corpus_hint", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
    T.StructField("missing_since", T.TimestampType()),
    T.StructField("error", T.StringType()),
])
FILE_COLUMNS = FILES.fieldNames()

# What one scan did to a row. Stored beside the catalog columns, so that the
# run's counters come from committed data and a re-run task cannot skew them.
SCAN_MARKS = T.StructType([
    T.StructField("visits", T.LongType()),
    T.StructField("hashed_now", T.BooleanType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("finished_at", T.TimestampType()),
    T.StructField("roots", T.ArrayType(T.StringType())),
    T.StructField("files_seen", T.LongType()),
    T.StructField("files_hashed", T.LongType()),
    T.StructField("bytes_total", T.LongType()),
    T.StructField("errors", T.LongType()),
    T.StructField("note", T.StringType()),
    # Bookkeeping of the snapshot store.
    T.StructField("seq", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("schema_version", T.IntegerType()),
    T.StructField("buckets", T.IntegerType()),
    T.StructField("staging", T.StringType()),
])
RUN_COLUMNS = RUNS.fieldNames()[:9]

# What a scan of storage yields, one row per visited file.
ENTRIES = T.StructType([
    T.StructField("root_ordinal", T.IntegerType()),
    T.StructField("root", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
    T.StructField("mtime", T.DoubleType()),
    T.StructField("error", T.StringType()),
])

# --- Fixed values -----------------------------------------------------------
# Extensions by category, spellings that share a format, corpus keywords in
# order of precedence, default exclusions and the folders reports call out.

EXTENSIONS = {
    "ebook_text": (
        "epub", "mobi", "azw", "azw3", "azw4", "kfx", "prc", "pdb", "fb2", "fbz",
        "lit", "lrf", "tcr", "pml", "rb", "snb", "html", "htm", "htmlz", "xhtml",
        "txt", "text", "rtf", "doc", "docx", "odt", "md", "markdown",
    ),
    "pdf": ("pdf",),
    "ebook_image": ("djvu", "djv", "cbz", "cbr", "cb7", "cbt", "cba"),
    "audio": (
        "mp3", "m4a", "m4b", "aac", "flac", "ogg", "oga", "opus", "wav", "wma",
        "aa", "aax",
    ),
    "archive": ("zip", "rar", "7z", "gz", "tgz", "bz2", "tar", "xz"),
    "metadata": (
        "opf", "jpg", "jpeg", "png", "gif", "tif", "tiff", "nfo", "json", "xml",
        "cue", "res", "mbp", "mbpv2", "phl", "apnx", "voucher", "tan",
    ),
}
SAME_FORMAT = {
    "fbz": "fb2", "htm": "html", "xhtml": "html", "text": "txt", "markdown": "md",
    "djv": "djvu", "oga": "ogg", "tgz": "gz", "jpeg": "jpg", "tiff": "tif",
}
ELIGIBLE_CATEGORIES = ("ebook_text", "pdf")
UNKNOWN_FORMAT = "unknown"
OTHER_CATEGORY = "other"
METADATA_CATEGORY = "metadata"

CORPUS_KEYWORDS = (
    ("ghostwriting", ("ghostwrit", "ghost-writ", "client")),
    ("untrusted-nonfiction", ("apologetic", "untrust", "creationism", "pseudo")),
    ("trusted-nonfiction", ("nonfiction", "non-fiction", "non fiction")),
    ("fiction", ("fiction", "novel", "sci-fi", "scifi", "fantasy", "romance")),
)
UNASSIGNED = "unassigned"

DEFAULT_EXCLUDES = (
    ".git", ".Trash-*", "@eaDir", "lost+found", "__MACOSX", ".DS_Store",
    "Thumbs.db", "*.tmp", "*.part", "*.crdownload", "*.opdownload",
)
CALLOUT_FOLDERS = ("15000KindleBooks", "AudioBooks", "ComicBookPDFs")
# --- End of fixed values ----------------------------------------------------
