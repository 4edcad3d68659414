"""Inverted-index text helpers, all as built-in array/map expressions.

An abstract arrives as ``map<word, array<position>>``. Rebuilding the text
means laying the words out by position, leaving empty slots for gaps, and
joining the slots with single spaces; where two words claim one position the
later map entry wins. Everything runs inside the JVM with one
``array_sort`` per row (O(n log n) in the number of tokens).

Each helper is a single Column expression. Intermediate arrays are bound
once with ``_let`` (a one-element ``transform``), never through separate
projections: the optimizer may push filters through projections and would
then substitute an intermediate array into a lambda body, recomputing it
per element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_SPLIT = r"[ \t\r\n]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def _first_or(first: Column, other: Column) -> Column:
    """``first OR other`` that never evaluates ``other`` when ``first`` holds
    (``other`` may index outside the array under ANSI mode)."""
    return F.when(first, F.lit(True)).otherwise(other)


def index_entries(index: Column | str) -> Column:
    """array<struct<k, w, v>>: one entry per distinct key of the index map.

    ``k`` is the key's entry number (first occurrence), ``w`` the word, ``v``
    the positions of its last occurrence, as a JSON object with a repeated
    key behaves once parsed. Entries come in ``k`` order. Maps without
    repeated keys skip the extra sorts.
    """
    m = _col(index)
    plain = F.transform(
        F.map_entries(m),
        lambda e, i: F.struct(i.alias("k"), e["key"].alias("w"), e["value"].alias("v")),
    )
    by_word = F.sort_array(
        F.transform(
            F.map_entries(m),
            lambda e, i: F.struct(e["key"].alias("w"), i.alias("k"), e["value"].alias("v")),
        )
    )
    merged = F.sort_array(_let(
        by_word,
        lambda s: F.zip_with(
            F.filter(s, lambda x, i: _first_or(i == 0, s[i - 1]["w"] != x["w"])),
            F.filter(s, lambda x, i: _first_or(i == F.size(s) - 1, s[i + 1]["w"] != x["w"])),
            lambda a, b: F.struct(a["k"].alias("k"), b["w"].alias("w"), b["v"].alias("v")),
        ),
    ))
    has_dup = F.size(F.array_distinct(F.map_keys(m))) < F.size(m)
    return F.when(has_dup, merged).otherwise(plain)


def _max_position(entries: Column) -> Column:
    return F.array_max(F.flatten(F.transform(entries, lambda e: e["v"])))


# A posting is packed into one long: position in the high bits, entry index
# in the low ENTRY_BITS bits. Sorting longs is a primitive sort, and equal
# positions come out in entry order, so the last of a run is the last writer.
ENTRY_BITS = 24
_ENTRY_MASK = (1 << ENTRY_BITS) - 1


def _join_slots(codes: Column, entries: Column) -> Column:
    """Packed postings (sorted, one per position) -> words separated by spaces,
    one extra space per empty slot in between."""
    return F.array_join(
        F.transform(
            codes,
            lambda c, i: F.concat(
                F.repeat(
                    F.lit(" "),
                    F.when(i == 0, F.shiftright(c, ENTRY_BITS)).otherwise(
                        F.shiftright(c, ENTRY_BITS) - F.shiftright(codes[i - 1], ENTRY_BITS) - 1
                    ).cast("int"),
                ),
                F.coalesce(entries[c.bitwiseAND(F.lit(_ENTRY_MASK)).cast("int")]["w"], F.lit("")),
            ),
        ),
        " ",
    )


def abstract_text(index: Column | str) -> Column:
    """Text rebuilt from an inverted index map.

    A null or empty index, or one without positions, gives "". A negative
    position counts from the end of the slot list (as list indexing does);
    one before the start is ignored. An index of more words than a posting
    can number fails the query rather than give another text.
    """

    def with_entries(ent: Column) -> Column:
        def with_max(mx: Column) -> Column:
            n_slots = mx + 1
            codes = F.sort_array(
                F.filter(
                    F.flatten(
                        F.transform(
                            ent,
                            lambda e, j: F.transform(
                                e["v"],
                                lambda p: F.shiftleft(
                                    F.when(p < 0, p + n_slots).otherwise(p).cast("long"), ENTRY_BITS
                                ) + j,
                            ),
                        )
                    ),
                    lambda c: c.isNotNull() & (c >= 0),
                )
            )
            # last writer per position: the final element of each run of equal positions
            last = _let(
                codes,
                lambda x: F.filter(
                    x,
                    lambda c, i: _first_or(
                        i == F.size(x) - 1, F.shiftright(x[i + 1], ENTRY_BITS) != F.shiftright(c, ENTRY_BITS)
                    ),
                ),
            )
            text = _let(last, lambda y: _join_slots(y, ent))
            return F.when(mx.isNull() | (mx < 0), F.lit("")).otherwise(F.coalesce(text, F.lit("")))

        return _let(_max_position(ent), with_max)

    m = F.col(index) if isinstance(index, str) else index
    too_many = F.raise_error(F.lit(f"an inverted index holds more than {1 << ENTRY_BITS} words")).cast("string")
    return F.when(F.size(m) > (1 << ENTRY_BITS), too_many).otherwise(
        F.coalesce(_let(index_entries(index), with_entries), F.lit(""))
    )


def index_postings(df: DataFrame, key_col: str, index_col: str = "abstract_inverted_index") -> DataFrame:
    """One row per (key, word, position) of an inverted index (repeated keys: last wins)."""
    return (
        df.select(key_col, F.explode(index_entries(index_col)).alias("e"))
        .select(key_col, F.col("e.w").alias("word"), F.explode("e.v").alias("position"))
        .filter(F.col("position").isNotNull())
        .withColumn("position", F.col("position").cast("bigint"))
    )


def index_extent(df: DataFrame, index_col: str = "abstract_inverted_index") -> DataFrame:
    """Add ``max_position`` (-1 when empty) and ``n_positions`` (distinct positions)."""
    positions = _let(index_entries(index_col), lambda ent: F.flatten(F.transform(ent, lambda e: e["v"])))
    stats = _let(
        positions,
        lambda ps: F.struct(
            F.coalesce(F.array_max(ps).cast("bigint"), F.lit(-1).cast("bigint")).alias("max_position"),
            F.coalesce(F.size(F.array_distinct(ps)), F.lit(0)).cast("bigint").alias("n_positions"),
        ),
    )
    return df.withColumn("__extent", stats).select(
        *[c for c in df.columns], "__extent.max_position", "__extent.n_positions"
    )


def tokens(text: Column | str) -> Column:
    """Non-empty whitespace-separated tokens of ``text``."""
    return F.filter(F.split(_col(text), TOKEN_SPLIT), lambda s: s != "")


def inverted_index(text: Column | str) -> Column:
    """map word -> ascending positions of the whitespace tokens of ``text``.

    Built per row: sort (word, position) pairs, cut the sorted array into runs
    of one word, and turn every run into one map entry. Words come out in
    sorted order. Empty or null text gives null.
    """
    pairs = F.sort_array(F.transform(tokens(text), lambda t, i: F.struct(t.alias("w"), i.alias("p"))))

    def from_sorted(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: _first_or(i == 0, s[i - 1]["w"] != s[i]["w"]),
        )

        def from_starts(r: Column) -> Column:
            return F.map_from_entries(
                F.transform(
                    r,
                    lambda st, j: F.struct(
                        s[st]["w"].alias("key"),
                        F.transform(
                            F.slice(s, st + 1, F.when(j + 1 < F.size(r), r[j + 1]).otherwise(F.size(s)) - st),
                            lambda e: e["p"],
                        ).alias("value"),
                    ),
                )
            )

        return F.when(F.size(s) > 0, _let(starts, from_starts))

    return _let(pairs, from_sorted)


def with_inverted_index(df: DataFrame, text_col: str, out: str = "abstract_inverted_index") -> DataFrame:
    return df.withColumn(out, inverted_index(text_col))
