"""Quality rules: per-document base rules, then lines that recur across documents of a host.

All of it is DataFrame expressions. The cross-document part hashes normalised lines (lower case, words
joined by one space), counts the distinct documents of a host (``source``) that hold each line, takes
lines above the limits for boilerplate, and rejects documents of which too few words remain.

Documents are distinct by their normalised text (all its lines with a word, normalised): exact copies count
once, so a text that is merely copied does not make its own lines boilerplate. Near copies are documents of their own.

Rows are told apart by document id, text and source. NULL text is a text without words (it fails the
base rules), NULL source is a host of its own, repeated rows get equal results and count as one document,
an empty table gives an empty result, further columns are ignored or, in ``clean_documents``, kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capplan.llm.common import OWN, SPACES, cut

#: A line is boilerplate of a host if at least so many of its distinct documents hold it ...
MIN_DOCS = 10
#: ... and at least this share of all documents of the host.
MIN_SHARE = 0.005
#: A document is depleted if less than this share of its words lies outside boilerplate lines.
MIN_LEFT = 0.3
#: Words of a window whose repetition within a document counts.
WINDOW = 8
#: Base rules: fewest words, and most repeated words of a hundred.
MIN_WORDS, MAX_REPEATED = 20, 30

_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(text: str) -> Column:
    trimmed = F.trim(F.col(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def _hash(line: Column) -> Column:
    return F.substring(F.md5(F.array_join(F.filter(F.split(F.lower(line), SPACES), lambda w: w != ""), " ")), 1, 16)


def _told_apart(documents: DataFrame) -> DataFrame:
    """Adds the text without NULL, the host, and a key that tells rows of one id apart."""
    text, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source"), F.lit(""))
    return documents.withColumns({f"{OWN}text": text, f"{OWN}host": host, f"{OWN}row": F.xxhash64(text, host)})


def base_rules(documents: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and, per row, the base measures of ``text`` and ``base_failed``.

    ``n_repeat_words`` counts the words inside a window of eight words that occurs twice or more in the text,
    the first occurrence included; windows are compared by 64-bit hashes, and only a text with a repeated
    window pays for finding where.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    words = documents.select(*kept, F.coalesce(F.col("text"), F.lit("")).alias("text")).select(
        *kept, "text", _words("text").alias("words")
    )
    windows = words.select(
        *kept,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \\t\\n\\x0B\\f\\r]")).alias("lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("words", i, WINDOW)),
            ),
        ).alias("windows"),
    )
    repeats = windows.select(
        *kept,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("sorted"),
    )
    twice = repeats.withColumn(
        "places",
        F.expr(
            "transform(filter(sorted, (s, j) -> s.h = get(sorted, j - 1).h or s.h = get(sorted, j + 1).h), s -> s.i)"
        ),
    )
    covered = F.expr(
        f"aggregate(sort_array(places), named_struct('n', 0L, 'end', 0), (a, i) -> named_struct("
        f"'n', a.n + (i + {WINDOW} - greatest(i, a.end)), 'end', i + {WINDOW}), a -> a.n)"
    )
    return twice.select(
        *kept, *_MEASURES[:-1], F.when(F.col("sorted").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words")
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    )


def _lines(documents: DataFrame) -> DataFrame:
    """One row per line with a word: host, row, document id, place, hash, words, and its text's identity."""
    hashed = _told_apart(documents).select(
        F.col("doc_id").alias("id"),
        F.col(f"{OWN}host").alias("host"),
        F.col(f"{OWN}row").alias("row"),
        F.transform(
            F.filter(F.split(f"{OWN}text", "\n"), lambda line: line.rlike("[^ \\t\\n\\x0B\\f\\r]")),
            lambda line: F.struct(
                _hash(line).alias("hash"), F.regexp_count(line, F.lit("[^ \\t\\n\\x0B\\f\\r]+")).alias("words")
            ),
        ).alias("lines"),
    )
    told = hashed.select("id", "host", "row", F.xxhash64("lines.hash").alias("text"), F.posexplode("lines").alias("place", "line"))
    return told.select(
        "id", "host", "row", "text", "place", F.col("line.hash").alias("hash"), F.col("line.words").alias("words")
    )


def boilerplate(
    documents: DataFrame, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE, lines: DataFrame | None = None
) -> DataFrame:
    """``host, hash, n_docs`` of the lines above the limits; as many rows as hosts have such lines."""
    counted = (
        (_lines(documents) if lines is None else lines)
        .select("host", "hash", "text")
        .distinct()
        .groupBy("host", "hash")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    hosts = documents.groupBy(F.coalesce(F.col("source"), F.lit("")).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs")
    )
    return cut(
        counted.join(hosts, "host").where(F.col("n_docs") >= min_share * F.col("host_docs")).select("host", "hash", "n_docs")
    )


def _removed(lines: DataFrame, common: DataFrame) -> DataFrame:
    """The boilerplate lines of each row that has any, each line of a row once."""
    return lines.join(common, ["host", "hash"]).dropDuplicates(["id", "row", "place"])


def _judged(documents: DataFrame, lines: DataFrame, common: DataFrame, min_left: float) -> DataFrame:
    """Per row its id and key, the base measures, the words in boilerplate lines, and the verdict."""
    rows = _told_apart(documents).withColumn("row", F.col(f"{OWN}row"))
    base = base_rules(rows, "doc_id", "row")
    removed = (
        _removed(lines, common)
        .groupBy(F.col("id").alias("r_id"), F.col("row").alias("r_row"))
        .agg(F.sum("words").alias("n_boilerplate_words"))
    )
    both = base.join(removed, base["doc_id"].eqNullSafe(removed["r_id"]) & (base["row"] == removed["r_row"]), "left")
    gone = F.coalesce(F.col("n_boilerplate_words"), F.lit(0)).cast("long")
    return both.select(
        "doc_id",
        "row",
        *_MEASURES,
        "base_failed",
        gone.alias("n_boilerplate_words"),
        (~F.col("base_failed") & (F.col("n_words") - gone >= min_left * F.col("n_words"))).alias("kept"),
    )


def judge(
    documents: DataFrame, min_left: float = MIN_LEFT, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE
) -> DataFrame:
    """``doc_id``, base measures, ``base_failed``, ``n_boilerplate_words`` and ``kept``, one row per row."""
    lines = cut(_lines(documents))
    common = boilerplate(documents, min_docs, min_share, lines)
    return _judged(documents, lines, common, min_left).drop("row")


def clean_documents(
    documents: DataFrame, min_left: float = MIN_LEFT, min_docs: int = MIN_DOCS, min_share: float = MIN_SHARE
) -> DataFrame:
    """The documents that pass, without their boilerplate lines; columns unchanged, ``n_chars`` brought up to date.

    Verdicts are stored before they filter: a filter pushed down into the measures would compute them anew.
    """
    columns = documents.columns
    lines = cut(_lines(documents))
    common = boilerplate(documents, min_docs, min_share, lines)
    verdicts = cut(_judged(documents, lines, common, min_left).select("doc_id", "row", "kept").distinct())
    removed = (
        _removed(lines, common)
        .groupBy(F.col("id").alias("g_id"), F.col("row").alias("g_row"))
        .agg(F.collect_set("hash").alias(f"{OWN}gone"))
    )
    passed = verdicts.where("kept").join(
        removed, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("row") == F.col("g_row")), "left"
    )
    kept = passed.select(F.col("doc_id").alias(f"{OWN}id"), F.col("row").alias(f"{OWN}key"), f"{OWN}gone")
    both = _told_apart(documents).join(
        kept, F.col("doc_id").eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}row") == F.col(f"{OWN}key"))
    )
    gone = F.col(f"{OWN}gone")
    left = F.array_join(
        F.filter(F.split("text", "\n"), lambda line: ~F.array_contains(gone, _hash(line))), "\n"
    )
    fresh = {"text": left, "n_chars": F.length(left).cast("long")}
    return both.select(
        *[
            (F.when(gone.isNotNull(), fresh[c]).otherwise(F.col(c)) if c in fresh else F.col(f"`{c}`")).alias(c)
            for c in columns
        ]
    )
