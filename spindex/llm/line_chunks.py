"""Removal of passages that documents share, by content-defined chunks of lines.

A rolling hash over the hashes of two lines is taken at every line. It decides
the boundaries: two neighbouring lines belong to one chunk if their rolling hash
was seen before, anywhere (in an earlier document, or further up in the same),
and a boundary lies between them if not. So a boundary depends on the two lines
beside it alone: whatever stands before or after a passage, its chunk begins and
ends where the passage does, and a chunk of two lines is found as surely as one
of a hundred. Chunks of two lines or more are removed; a line by itself is never
one. The first occurrence, by (id, text hash, place), is what stays: the first
occurrence of a line is never in a chunk, so no line disappears altogether. Two
neighbouring blank lines say nothing and are no part of a chunk.

First pass: every pair of neighbouring lines is a 64-bit hash; hashes found once
are done. Second pass: the pairs whose hashes were found again are compared byte
for byte (the smallest and the largest text behind a hash must be equal) before
anything goes. Third pass: documents that lose chunks are rebuilt. Only small
rows and repeated pairs are shuffled; copies are combined where they are read.

All of it is DataFrame operations. Null text stays null; an empty text is one
empty line. Rows equal in id and text are one document: they keep or lose the
same chunks. Null ids come first. Of a line that fills a text again and again
one is left. Columns of the documents are kept, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, saved, text_of

#: Documents that lose lines up to whose number of removed pairs the table of them is broadcast.
BROADCAST_PAIRS = 500_000
WORD_RE = r"[^\x20\x09-\x0D]"


def with_lines(docs: DataFrame) -> DataFrame:
    """Adds the lines and ``_llm_pairs``: for each pair of neighbouring lines
    that aren't both blank the place k of the first (from 0) and the rolling hash."""
    one = docs.withColumn("_llm_lines", F.split(text_of(), "\n"))
    one = one.withColumn("_llm_hashes", F.transform("_llm_lines", lambda x: F.struct(
        F.xxhash64(x).alias("h"), F.rlike(x, F.lit(WORD_RE)).alias("words"))))
    h, n = F.col("_llm_hashes"), F.size("_llm_lines")
    places = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    places = F.filter(places, lambda k: F.get(h, k)["words"] | F.get(h, k + 1)["words"])
    return one.withColumn("_llm_pairs", F.transform(places, lambda k: F.struct(
        k.alias("k"), F.xxhash64(F.get(h, k)["h"], F.get(h, k + 1)["h"]).alias("a")))).drop("_llm_hashes")


def keyed(docs: DataFrame) -> DataFrame:
    """(_llm_id, _llm_null, _llm_mark) tell documents apart; null text is left out."""
    return docs.withColumns({"_llm_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
                             "_llm_null": F.col("doc_id").isNull(), "_llm_mark": F.xxhash64(F.col("text"))})


KEY = ["_llm_null", "_llm_id", "_llm_mark"]


def pair_rows(docs: DataFrame, with_text: bool) -> DataFrame:
    """One row a pair of neighbouring lines: key, k, and its hash a (and its text)."""
    one = with_lines(keyed(docs.select("doc_id", "text").where("text is not null")))
    text = ["_llm_lines"] if with_text else []
    # explode_outer and a filter: for a plain explode the optimizer infers a filter on the array's size, in which
    # the hashes are taken anew for every line
    rows = (one.select(*KEY, *text, F.explode_outer("_llm_pairs").alias("p")).where(F.col("p").isNotNull())
            .select(*KEY, *text, "p.k", "p.a"))
    if with_text:
        lines, k = F.col("_llm_lines"), F.col("k")
        rows = rows.select(*KEY, "k", "a", F.concat(F.get(lines, k), F.lit("\n"), F.get(lines, k + 1)).alias("text"))
    return rows


def removed_pairs(docs: DataFrame) -> DataFrame:
    """(key, gone): the pairs of lines each document loses, as an array of their places."""
    again = saved(pair_rows(docs, with_text=False).groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                  "line-repeats")
    live = saved(lookup_join(pair_rows(docs, with_text=True), again, "a", "n", "inner").drop("n"), "line-pairs")
    same = (live.groupBy("a").agg(F.min("text").alias("x"), F.max("text").alias("y")).where("x = y").select("a"))
    place = F.struct(~F.col("_llm_null"), F.col("_llm_id"), F.col("_llm_mark"), F.col("k"))
    small = live.select(*KEY, "k", "a")
    first = small.groupBy("a").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = saved(first.join(same, "a"), "line-groups")
    later = lookup_join(small, groups, "a", "n", "inner").where(place > F.col("first"))
    return later.groupBy(*KEY).agg(F.collect_set("k").alias("_llm_gone"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, without the chunks that come again; their own columns and
    ``_llm_lines_removed``. ``n_chars`` follows the text where the column is there."""
    gone = saved(removed_pairs(docs), "line-gone")
    n = gone.agg(F.coalesce(F.sum(F.size("_llm_gone")), F.lit(0))).first()[0]
    marked = keyed(docs).join(F.broadcast(gone) if n <= BROADCAST_PAIRS else gone, KEY, "left")
    marked = marked.withColumn("_llm_lines", F.when(F.col("_llm_gone").isNotNull(), F.split(text_of(), "\n")))
    lines, pairs = F.col("_llm_lines"), F.col("_llm_gone")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1),
                            F.concat(pairs, F.transform(pairs, lambda k: k + 1)))
    out = marked.withColumn("_llm_stay", F.when(pairs.isNotNull(), F.transform(places, lambda k: F.get(lines, k))))
    changed = F.col("_llm_stay").isNotNull()
    text = F.when(changed, F.array_join("_llm_stay", "\n")).otherwise(F.col("text"))
    out = out.withColumn("_llm_lines_removed", F.when(changed, F.size("_llm_lines") - F.size("_llm_stay"))
                         .otherwise(0).cast("long")).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns, "_llm_lines_removed")


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
           FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, i, line, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS below FROM l),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY line, below ORDER BY doc_id, i) AS place FROM p
      WHERE below IS NOT NULL AND regexp_matches(line || below, '[^\x20\x09-\x0D]')) WHERE place > 1),
x AS (SELECT DISTINCT doc_id, unnest([i, i + 1]) AS i FROM g),
o AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE x.i IS NULL) AS text, count(x.i) AS lines_removed
      FROM l LEFT JOIN x ON l.doc_id = x.doc_id AND l.i = x.i GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(o.text, '') END AS text, coalesce(lines_removed, 0) AS lines_removed
FROM documents d LEFT JOIN o USING (doc_id)
"""
