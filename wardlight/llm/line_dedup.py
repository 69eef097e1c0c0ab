"""Dropping recurring lines with a log-template tree of fixed depth.

A line walks down the tree by its number of tokens and its leading tokens; tokens
with digits are variable and count as one wildcard. In a leaf its templates are the
line itself and the line with some of the tokens after the leading ones left open:
lines that differ in those fields share the template. Which tokens are open follows
from the leaf: for each number of documents that a token of the line has at its
place, the template keeps the tokens that have as many, and opens the rarer ones, up
to a ``MAX_OPEN``-th of the line. Lines of ``MIN_FIELD_TOKENS`` and more also get
templates with one run of tokens open. A template found in ``min_docs`` documents or
more recurs, and so does a line of ``LONG_LINE`` tokens and more that stands word for
word in ``LONG_MIN_DOCS`` documents. Its lines are dropped, but for those of its first
document (smallest id), so that no content is lost altogether.

The levels prune each other: a first pass looks at the number of tokens and the leading
ones only, and only lines of leaves with as many lines as a template of theirs needs are
hashed token by token. Only hashes travel, and all steps are built-in functions.

Defined cases: a NULL text has no lines and stays NULL; lines without tokens stay
and are no templates; the NULL id is last in the order; rows with equal id and text
are one document, so equal rows fare alike; a row all of whose tokens went is left
out by ``drop_recurring`` and stays, empty, in ``find_recurring``.
Texts of any length are split in their row; carried columns are kept in a struct, so
their names cannot clash; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import quoted, row_tag, stored, words
from wardlight.session import Scratch

MIN_DOCS = 10
LONG_LINE = 10
LONG_MIN_DOCS = 2
LEADING = 3
RUNS = 3
MIN_FIELD_TOKENS = 9
MAX_OPEN = 3
WILDCARD = "<*>"


def _open_run(hashes: str, run: int) -> Column:
    """A template key with one run after the leading tokens left open."""
    rest = F.size(hashes) - LEADING
    at = lambda part: (F.lit(LEADING) + F.floor(rest * part / RUNS)).cast("int")
    return F.xxhash64(
        F.lit(run), F.size(hashes), F.slice(hashes, F.lit(1), at(run)),
        F.slice(hashes, at(run + 1) + 1, F.size(hashes)),
    )


TOKEN = r"(?<![^ \t-\r])[^ \t-\r0-9]*+[0-9][^ \t-\r]*+"


def _hashed(body: str) -> tuple[Column, Column]:
    """The line with its variable tokens masked, and the hashes of its tokens."""
    masked = F.when(F.col(body).rlike("[0-9]"), F.regexp_replace(body, TOKEN, WILDCARD)).otherwise(
        F.col(body))
    return masked, F.transform(words(F.col("masked")), lambda t: F.xxhash64(t))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tag, line, number of tokens and leaf of each line.

    Only the leading tokens are looked at; in a line of words with one blank between
    any two the others are counted by their blanks.
    """
    body = F.col("body")
    odd = [body.contains(c) for c in ("  ", "\t", "\v", "\f", "\r")]
    plain = (body != "") & ~reduce(or_, [*odd, body.startswith(" "), body.endswith(" ")])
    blanks = F.octet_length(body) - F.octet_length(F.replace(body, F.lit(" "), F.lit("")))
    found = (
        docs.select("doc_id", row_tag().alias("tag"),
                    F.posexplode(F.split("text", "\n", -1)).alias("line", "body"))
        .select(
            "doc_id", "tag", "line",
            F.when(plain, blanks + 1).otherwise(F.size(words(body))).alias("n"),
            F.when(plain, F.substring_index(body, " ", LEADING)).otherwise(
                F.array_join(F.slice(words(body), 1, LEADING), " ")).alias("lead"),
        )
    )
    masked = F.when(F.col("lead").rlike("[0-9]"), F.regexp_replace("lead", TOKEN, WILDCARD))
    return found.select(
        "doc_id", "tag", "line", "n", F.xxhash64("n", masked.otherwise(F.col("lead"))).alias("leaf"))


def _lines_of(docs: DataFrame, held: DataFrame) -> DataFrame:
    """The held lines with their token hashes and exact key, made from the texts again.

    Only these lines are split into tokens, and no token of another line travels.
    ``exact`` is NULL for short lines.
    """
    wanted = held.groupBy("doc_id", "tag").agg(
        F.collect_set(F.struct("line", "leaf", "full")).alias("lines")
    ).select(F.col("doc_id").alias("in_doc"), F.col("tag").alias("in_row"), "lines")
    rows = docs.select("doc_id", "text", row_tag().alias("tag")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("tag") == F.col("in_row")))
    masked, hashes = _hashed("body")
    # Without a variable token the masked line is the line.
    exact = F.when(F.col("masked") == F.col("body"), F.xxhash64(F.lit("exact"), "hashes")).otherwise(
        F.xxhash64(F.lit("exact"), F.transform(words(F.col("body")), lambda t: F.xxhash64(t))))
    return (
        rows.select("doc_id", "tag", "lines", F.split("text", "\n", -1).alias("bodies"))
        .select("doc_id", "tag", F.explode(F.transform("lines", lambda x: F.struct(
            x["line"].alias("line"), x["leaf"].alias("leaf"), x["full"].alias("full"),
            F.get("bodies", x["line"]).alias("body")))).alias("x"))
        .select("doc_id", "tag", "x.line", "x.leaf", "x.full", "x.body")
        .select("doc_id", "tag", "line", "leaf", "full", "body", masked.alias("masked"))
        .select("doc_id", "tag", "line", "leaf", "full", "body", "masked", hashes.alias("hashes"))
        .select("doc_id", "tag", "line", "leaf", "full", "hashes", F.size("hashes").alias("n"),
                F.when(F.size("hashes") >= LONG_LINE, exact).alias("exact"))
    )


def _field_keys(lines: DataFrame, min_docs: int, scratch: Scratch) -> DataFrame:
    """doc_id, tag, line and the key of each template with fields that the leaf suggests."""
    who = ("doc_id", "tag", "line")
    places = lines.select(
        *who, "n", "leaf",
        F.posexplode(F.slice("hashes", F.lit(LEADING + 1), F.col("n"))).alias("pos", "token"),
    ).select(*who, "n", "leaf", "pos", "token", F.xxhash64("leaf", "pos", "token").alias("place"))
    # Stored, so that the join reads plain shuffles and a hot place can be split.
    common = scratch.store(
        places.groupBy("place", "doc_id", "tag").agg(F.lit(1).alias("one"))
        .groupBy("place").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs),
        "common-tokens",
    )
    # A token that is not common has 0 documents; the leading ones are never open.
    counted = (
        places.join(common, "place", "left")
        .groupBy(*who, "n", "leaf")
        # A set, for equal rows are one document.
        .agg(F.sort_array(F.collect_set(F.struct(
            "pos", "token", F.coalesce("docs", F.lit(0).cast("long")).alias("docs"))))
            .alias("tokens"))
    )
    every = F.lit((1 << 63) - 1).cast("long")
    least = F.array_union(F.array(every), F.filter(
        F.transform("tokens", lambda t: t["docs"]), lambda c: c > 0))
    opened = F.size(F.filter("tokens", lambda t: t["docs"] < F.col("least")))
    return (
        counted.select(*who, "n", "leaf", "tokens", F.explode(least).alias("least"))
        .where((opened > 0) & (opened * MAX_OPEN <= F.col("n")))
        .select(*who, F.xxhash64(F.lit("fields"), "leaf", F.transform(
            "tokens", lambda t: F.when(t["docs"] >= F.col("least"), t["token"])
            .otherwise(F.xxhash64(F.lit(WILDCARD))))).alias("key"))
    )


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, tag and the sorted numbers of the lines to drop; only rows with such lines.

    The result is a stored table; those made on the way are removed.
    """
    few = min(min_docs, LONG_MIN_DOCS)
    with Scratch(docs.sparkSession, "lines") as scratch:
        # Stored, so that the joins read plain shuffles and a hot key can be split.
        every = scratch.store(leaves(docs), "leaves")
        lines = every.where("n > 0")
        busy = scratch.store(
            lines.groupBy("leaf", "n").agg(F.count("*").alias("found"))
            .where(F.col("found") >= F.when(F.col("n") >= LONG_LINE, few).otherwise(min_docs))
            .select("leaf", (F.col("found") >= min_docs).alias("full")),
            "busy-leaves",
        )
        held = scratch.store(_lines_of(docs, lines.join(busy, "leaf")), "busy-lines")
        scratch.drop(every, busy)
        full = held.where("full")
        whole = F.xxhash64("hashes")
        keys = F.when(F.col("n") >= MIN_FIELD_TOKENS, F.array(
            whole, *[_open_run("hashes", r) for r in range(RUNS)])).otherwise(F.array(whole))
        key = lambda df, column, needed: df.select(
            "doc_id", "tag", "line", column.alias("key"), F.lit(needed).alias("needed"))
        fields = _field_keys(full.where(F.col("n") > LEADING), min_docs, scratch)
        placed = scratch.store(
            key(held.where("exact IS NOT NULL"), F.col("exact"), few)
            .unionByName(key(full, F.explode(keys), min_docs))
            .unionByName(key(fields, F.col("key"), min_docs)),
            "line-keys",
        )
        scratch.drop(held)
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
        spread = scratch.store(
            placed.groupBy("key", "needed", "doc_id", "tag").agg(F.lit(1).alias("one"))
            .groupBy("key", "needed").agg(F.count("*").alias("docs"), F.min(order).alias("first"))
            .where(F.col("docs") >= F.col("needed")).select("key", "first"),
            "recurring-keys",
        )
        return stored(
            placed.join(spread, "key").where(order != F.col("first"))
            .groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set("line")).alias("dropped")),
            "recurring-lines",
        )


def find_recurring(
    docs: DataFrame, min_docs: int = MIN_DOCS, carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Per input row: the carried columns as ``row``, n_lines, ``dropped`` and ``kept_text``."""
    found = recurring_lines(docs.select("doc_id", "text"), min_docs).select(
        F.col("doc_id").alias("in_doc"), F.col("tag").alias("in_row"), "dropped"
    )
    rows = docs.select(F.struct(*map(quoted, carry)).alias("row"), "doc_id", "text",
                       row_tag().alias("tag"))
    lines = F.split("text", "\n", -1)
    none = F.array().cast("array<int>")
    return (
        rows.join(found, F.col("doc_id").eqNullSafe(F.col("in_doc"))
                  & (F.col("tag") == F.col("in_row")), "left")
        .select("row", "text", lines.alias("lines"), F.coalesce("dropped", none).alias("dropped"))
        .select("row", "text", "lines", "dropped", F.when(F.size("dropped") > 0, F.array_except(
            F.sequence(F.lit(0), F.size("lines") - 1), "dropped")).alias("kept"))
        .select(
            "row", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), "dropped",
            F.when(F.size("dropped") == 0, F.col("text")).otherwise(
                F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
            ).alias("kept_text"),
        )
    )


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs`` without their recurring lines, with the same columns.

    ``n_chars``, where there is such a column, follows the text.
    """
    found = find_recurring(docs, min_docs, tuple(docs.columns))
    emptied = (F.size("dropped") > 0) & ~F.col("kept_text").rlike(r"[^ \t-\r]")
    columns = [
        F.col("kept_text").alias(c) if c == "text"
        else F.when(F.size("dropped") > 0, F.char_length("kept_text")).otherwise(F.col("row.n_chars"))
        .cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ]
    return found.where(~emptied).select(*columns)
