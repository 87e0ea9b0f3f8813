"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one document: words, symbols, repeated lines and repeated
three-word windows. The method then looks across documents: every line that
has a word is normalised (digits, no white space) and hashed, and per
host the different texts that hold it are counted. Lines held by more than
``MAX_TEXTS`` texts and more than ``MAX_SHARE`` of the host's texts are
removed, and a document that loses more than ``DEPLETED`` of the characters
in its words is rejected.

Copies of one text count once, so a text is not rejected for being copied.
Nulls and empty texts have no words and fail the base rules; a null host is a
host of its own; rows that share an id share the verdict on their lines taken
together; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pawprint.llm.common import need

MAX_TEXTS = 50
MAX_SHARE = 0.01
DEPLETED = 0.5
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: White space, as the inside of a regular expression's class.
_BLANKS = r"\x20\x09-\x0D"


def _plain(text):
    """``text`` with single blanks between its words and none around."""
    return F.trim(F.regexp_replace(text, f"[{_BLANKS}]+", " "))


def _words(plain):
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _repeat_words(words):
    """Words inside three-word windows that occur twice or more.

    Only documents in which a window repeats are sorted: windows as (hash,
    place) in order, those equal to a neighbour, and the places they cover.
    """
    n = F.size(words)
    windows = F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    return windows


def base_columns(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with the base counts and ``base_failed``."""
    text = F.coalesce("text", F.lit(""))
    df = docs.withColumn("plain", _plain(text)).withColumn("words", _words(F.col("plain")))
    df = df.withColumn("windows", _repeat_words(F.col("words")))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    places = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("ranked", F.when(repeats, places))
    again = F.filter(F.transform("ranked", lambda s, k: F.when(
        (F.get("ranked", k + 1)["h"] == s["h"]) | (F.get("ranked", k - 1)["h"] == s["h"]),
        s["i"])), lambda i: i.isNotNull())
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        again, lambda i: F.array(i, i + 1, i + 2)))))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_BLANKS}]"))
    df = df.withColumn("lines", lines)
    return (df.withColumn("n_words", F.size("words").cast("long"))
            .withColumn("word_chars", F.length(F.replace("plain", F.lit(" "), F.lit("")))
                        .cast("long"))
            .withColumn("n_symbols", F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))
                        .cast("long"))
            .withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines")))
                        .cast("long"))
            .withColumn("n_repeat_words", F.when(repeats, covered).otherwise(0).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) |
                        (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .drop("plain", "words", "windows", "ranked", "lines"))


def _line_form(text):
    """Lines as they are compared: without white space, digits as 0."""
    return F.regexp_replace(F.regexp_replace(text, r"[\x09\x0B-\x0D\x20]+", ""), "[0-9]", "0")


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, host, text hash, line hash and size of every line that has a word.

    Lines are compared without white space and with digits as 0; the size is
    in characters of that form.
    """
    text = F.coalesce("text", F.lit(""))
    return (docs.select("doc_id", "host", F.xxhash64(text).alias("text_hash"),
                        F.explode(F.split(_line_form(text), "\n")).alias("line")).filter("line <> ''")
            .select("doc_id", "host", "text_hash", F.xxhash64("line").alias("line_hash"),
                    F.length("line").cast("long").alias("n")))


def common_lines(lines: DataFrame, texts: DataFrame, max_texts: int = MAX_TEXTS,
                 max_share: float = MAX_SHARE) -> DataFrame:
    """host, line_hash of the lines above the limits. ``texts``: host and hash of
    every text with a word.

    Texts are counted once per line by partial aggregates; hot hosts and hot
    lines shrink before they are shuffled."""
    held = lines.groupBy("host", "line_hash", "text_hash").agg(F.lit(1).alias("one"))
    per_line = held.groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("texts"))
    per_host = (texts.distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_texts"))
                .withColumnRenamed("host", "of"))
    return (per_line.filter(F.col("texts") > max_texts)
            .join(per_host, F.col("host").eqNullSafe(F.col("of")))
            .filter(F.col("texts") > max_share * F.col("host_texts"))
            .select("host", "line_hash"))


def _removed_lines(docs: DataFrame, max_texts: int, max_share: float) -> DataFrame:
    """``document_lines`` that are common on their host."""
    lines = document_lines(docs)
    text = F.coalesce("text", F.lit(""))
    texts = (docs.filter(text.rlike(f"[^{_BLANKS}]"))
             .select("host", F.xxhash64(text).alias("text_hash")))
    common = common_lines(lines, texts, max_texts, max_share).select(
        F.col("host").alias("h"), F.col("line_hash").alias("l"))
    return lines.join(common, F.col("host").eqNullSafe(F.col("h")) &
                      (F.col("line_hash") == F.col("l")), "left_semi")


def cleaned(docs: DataFrame, host: str = "source", max_texts: int = MAX_TEXTS,
            max_share: float = MAX_SHARE) -> DataFrame:
    """doc_id, host and the text without its host's common lines, per row; other lines and a
    null text stay as they are."""
    docs = need(docs, "doc_id", "text", host).withColumnRenamed(host, "host")
    out = (_removed_lines(docs, max_texts, max_share).groupBy("host", "text_hash")
           .agg(F.collect_set("line_hash").alias("gone"))
           .select(F.col("host").alias("h"), F.col("text_hash").alias("t"), "gone"))
    # A blank line has no form and is never common.
    stay = F.filter(F.split("text", "\n"), lambda x: (_line_form(x) == "") | ~F.array_contains(
        "gone", F.xxhash64(_line_form(x))))
    return (docs.join(out, F.col("host").eqNullSafe(F.col("h")) &
                      (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("t")), "left")
            .select("doc_id", F.col("host").alias(host),
                    F.when(F.col("gone").isNull(), F.col("text"))
                    .otherwise(F.array_join(stay, "\n")).alias("text")))


def quality(docs: DataFrame, host: str = "source", max_texts: int = MAX_TEXTS,
            max_share: float = MAX_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """The base counts, base_failed, characters in removed lines, and ``kept``, per row."""
    docs = need(docs, "doc_id", "text", host).withColumnRenamed(host, "host")
    lost = (_removed_lines(docs, max_texts, max_share).groupBy("doc_id").agg(F.sum("n").alias("removed"))
            .withColumnRenamed("doc_id", "id"))
    total = need(docs, "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"))
    lost = (lost.join(total, F.col("id").eqNullSafe(F.col("doc_id")))
            .select("id", (F.col("removed") / F.col("copies")).alias("removed")))
    base = base_columns(docs)
    return (base.join(lost, F.col("doc_id").eqNullSafe(F.col("id")), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.coalesce("removed", F.lit(0.0))
                                              <= depleted * F.col("word_chars"))).alias("kept"),
                    F.coalesce("removed", F.lit(0.0)).alias("removed_chars")))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
       regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, i, w[i:i + 2] AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i
        FROM d WHERE len(w) >= 3)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT win.rid, unnest(range(i, i + 3)) AS p
        FROM win JOIN (SELECT rid, k FROM win GROUP BY ALL HAVING count(*) > 1) g
          ON g.rid = win.rid AND g.k = win.k) GROUP BY rid),
raw AS (SELECT rid, doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT rid, doc_id, source, t, line, regexp_replace(regexp_replace(line,
         '[\x20\x09-\x0D]+', '', 'g'), '[0-9]', '0', 'g') AS nl
       FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY rid),
per AS (SELECT source, nl, count(DISTINCT t) AS texts FROM ln GROUP BY ALL),
host AS (SELECT source, count(DISTINCT t) AS texts FROM ln GROUP BY source),
com AS (SELECT per.source, nl FROM per JOIN host ON per.source IS NOT DISTINCT FROM host.source
        WHERE per.texts > {MAX_TEXTS} AND per.texts > {MAX_SHARE} * host.texts),
lost AS (SELECT rid, sum(length(ln.nl))::DOUBLE AS n FROM ln JOIN com
         ON com.nl = ln.nl AND com.source IS NOT DISTINCT FROM ln.source GROUP BY rid),
b AS (SELECT rid, doc_id, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
        coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(lost.n, 0) AS removed_chars
      FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)
         AND removed_chars <= {DEPLETED} * word_chars AS kept, removed_chars
FROM b
"""
