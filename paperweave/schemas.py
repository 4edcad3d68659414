"""Input and output schemas, plus the fixed values the outputs must agree on.

Everything here is data, not logic: the raw work record as read from JSON
lines, the column layout of every output table, and the handful of
constants (kept work types, venue names, thresholds) whose values define the
results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must be exactly these for matching results)
# ---------------------------------------------------------------------------

# Work types that enter the paper index.
KEEP_TYPES = ("article", "book-chapter", "preprint", "review", "letter", "book-section")

# Venue names (compared lower-cased) used by the LCC sanity check.
VALIDATION_VENUES = ("nature", "science")
# Number of top-cited venue papers inspected, and the warning threshold.
VALIDATION_TOP_N = 100
VALIDATION_WARN_BELOW = 95

# Component searches done by the seeded largest-component rule.
SEEDED_REPEATS = 5

# Category type tags.
MAIN_TYPE = "main"
SUB_TYPE = "sub"

# Rows per Parquet file for the unfiltered abstract sink.
ABSTRACT_ROWS_PER_FILE = 1_000_000

# ---------------------------------------------------------------------------
# Raw work record (only the fields that are read; the rest is ignored)
# ---------------------------------------------------------------------------

_named_entity = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("display_name", T.StringType()),
    ]
)

SOURCE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("issn_l", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

AUTHOR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("orcid", T.StringType()),
    ]
)

WORK = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("publication_year", T.IntegerType()),
        T.StructField("publication_date", T.StringType()),
        T.StructField("cited_by_count", T.LongType()),
        T.StructField(
            "primary_location",
            T.StructType([T.StructField("source", SOURCE)]),
        ),
        T.StructField("referenced_works", T.ArrayType(T.StringType())),
        T.StructField(
            "authorships",
            T.ArrayType(T.StructType([T.StructField("author", AUTHOR)])),
        ),
        T.StructField(
            "topics",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("field", _named_entity),
                        T.StructField("subfield", _named_entity),
                    ]
                )
            ),
        ),
        T.StructField(
            "abstract_inverted_index",
            T.MapType(T.StringType(), T.ArrayType(T.IntegerType())),
        ),
    ]
)

# A record's position as one bigint: file number, line in the file, place inside the record
# (22 + 27 + 14 bits: 4 million files, 134 million lines a file, 16 thousand places a record).
FILE_BITS, LINE_BITS, PLACE_BITS = 22, 27, 14

# ---------------------------------------------------------------------------
# Output tables (column names and types are fixed values too: consumers of the
# written tables read them by these names)
# ---------------------------------------------------------------------------


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _schema(spec: str) -> T.StructType:
    """``"a bigint, b string"`` -> StructType (no session needed)."""
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ]))
    return T.StructType(fields)


PAPER_TABLE = _schema(
    "paper_id bigint, openalex_id bigint, title string, year int, doi string, type string, "
    "publication_date string, frac_year double, cited_by_count bigint, language string, "
    "source_id bigint, is_connected int"
)
PAPER_METADATA = _schema(
    "paper_id bigint, openalex_id bigint, title string, year int, doi string, type string, "
    "publication_date string, frac_year double, cited_by_count bigint, language string, "
    "source_id bigint"
)
CITATION_NET = _schema("src bigint, dst bigint")
AUTHOR_TABLE = _schema("author_id bigint, openalex_author_id bigint, name string, orcid string")
PAPER_AUTHOR_NET = _schema("paper_id bigint, author_id bigint")
CATEGORY_TABLE = _schema("class_id bigint, type string, title string, openalex_id bigint")
PAPER_CATEGORY_TABLE = _schema(
    "paper_id bigint, main_class_id bigint, sub_class_id bigint, sequence bigint"
)
ABSTRACTS = _schema("paper_id bigint, abstract string")
SOURCE_TABLE = _schema(
    "source_id bigint, openalex_source_id bigint, display_name string, issn_l string, type string"
)
REGISTRY_PAPERS = _schema("paper_id bigint, openalex_id bigint")
REGISTRY_AUTHORS = _schema("author_id bigint, openalex_author_id bigint")
REGISTRY_META = _schema("n_papers bigint, n_authors bigint, sync_date string")
GRAPH_SHAPE = _schema("n_rows bigint, n_cols bigint, nnz bigint")

# Name -> schema of every table a dataset directory holds (CSV or Parquet).
TABLES = {
    "paper_table": PAPER_TABLE,
    "citation_net": CITATION_NET,
    "author_table": AUTHOR_TABLE,
    "paper_author_net": PAPER_AUTHOR_NET,
    "category_table": CATEGORY_TABLE,
    "paper_category_table": PAPER_CATEGORY_TABLE,
    "abstracts": ABSTRACTS,
    "source_table": SOURCE_TABLE,
    "registry_papers": REGISTRY_PAPERS,
    "registry_authors": REGISTRY_AUTHORS,
    "registry_meta": REGISTRY_META,
}
