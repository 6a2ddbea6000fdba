"""How far apart sources are, by three-dimensional cube partitioning.

Within a language every source is a group with a distribution over the
language's terms. The divergence of every group from every other is a sum over
all terms. Its work is a cube (group, group, term), cut into cells: a cell owns
a block of groups, another block of groups and a block of terms. The counts of
a (group block, term block) slice are replicated to the cells that need them;
a cell makes dense matrices of its slices, computes the partial divergences of
its pairs in both directions, and the partial sums are added along the term
axis. Terms that occur in neither slice of a cell aren't sent: their shares
are those of a count of zero, and only their number is needed.

Texts are counted inside the tasks that read them, by (language, source, term),
so a hot source or term is combined before any shuffle. A cell holds at most
2 * ``GROUPS`` groups (about) and ``TERMS`` terms (about) of counts.

All arithmetic is in whole numbers: a share is 1 + floor(10^9 * (count + 1) /
(N + V)) by long division in steps of 1000 (exact while N + V < 9 * 10^15), a
term's part floor((p - q)^2 / q). Every table between the steps is a Spark
table; nothing is collected but the number of rows of a lookup table.

Null text, language and source are the empty string. Every row counts, also a
repeated one; ids and other columns are not read. A language without kept terms
gives its pairs with 0 and no terms; a language with one source gives no pair.
Ties are ordered by the item's UTF-8. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Rows, columns_of, lookup_join, saved, text_of, workers

SCALE_STEPS, STEP = 3, 1000  # shares are of 10 ** 9
LEAST_DOCS, RANKS = 3, 200
GROUPS, TERMS = 64, 8192
#: A task adds up counts of so many (language, source, term) before it gives them out.
HELD = 1_000_000

COUNTS = "lang string, source string, term string, n long, docs long"
COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                          ("docs", pa.int64())])
PARTIAL = "lang string, source string, item string, value long"
PARTIAL_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

UPPER = bytes(range(65, 91))
#: Bytes of a term: letters, lower-cased, and all of a code point from U+0080 on; the rest become blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences, and rows that have the term."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = list(n)
            for lo in range(0, len(terms), 50_000):
                own = terms[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang), len(own)), pa.repeat(pa.scalar(source), len(own)),
                     pa.array(own, pa.binary()).cast(pa.string()), pa.array([n[t] for t in own], pa.int64()),
                     pa.array([docs[t] for t in own], pa.int64())], schema=COUNTS_ARROW)
        groups.clear()

    for batch in batches:
        for lang, source, text in columns_of(batch, "lang", "source", "text", raw=("text",)):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            own = Counter(text.translate(TERM_BYTES).split())
            n.update(own)
            docs.update(own.keys())
            held += len(n) - before
            if held >= HELD:
                yield from given()
                held = 0
    yield from given()


def share(count, total):
    """1 + floor(10^9 * (count + 1) / total), by long division (columns or arrays of whole numbers)."""
    cols = isinstance(count, Column)
    rest, out = count + 1, F.lit(0).cast("long") if cols else np.int64(0)
    for _ in range(SCALE_STEPS):
        wide = rest * STEP
        out, rest = out * STEP + (F.call_function("div", wide, total) if cols else wide // total), wide % total
    return out + 1


def cell_partials(block: np.ndarray, totals: np.ndarray, v: int, counts: np.ndarray,
                  one_block: bool) -> Iterator[tuple[int, int, int]]:
    """(group, other, partial sum) of a cell: ``counts`` has a row a group and a
    column for each term that occurs in the cell, of ``v`` terms in all."""
    totals = np.maximum(totals, 1)  # without any kept term there is nothing to add up
    p = share(counts, totals[:, None])
    zero = share(np.zeros(len(totals), np.int64), totals)
    absent = v - counts.shape[1]
    places = np.arange(len(totals))
    for i in places.tolist():
        others = np.flatnonzero(places != i if one_block else block != block[i])
        q = p[others]
        d, d0 = p[i] - q, zero[i] - zero[others]
        value = (d * d // q).sum(1) + absent * (d0 * d0 // zero[others])
        yield from zip([i] * len(others), others.tolist(), value.tolist(), strict=True)


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (lang, lo, hi, tb), in a cell by ``kind``: 0 a group with its
    total and the cell's number of terms, 1 a count."""
    out, now = Rows(PARTIAL_ARROW), None
    groups: dict[str, int] = {}
    facts: list[tuple[int, int, int]] = []
    terms: dict[str, int] = {}
    found: list[tuple[int, int, int]] = []

    def settle() -> None:
        if len(groups) < 2:
            return
        counts = np.zeros((len(groups), len(terms)), np.int64)
        if found:
            g, t, n = np.array(found, np.int64).T
            counts[g, t] = n
        block, total, v = np.array(facts, np.int64).T
        names = list(groups)
        for i, j, value in cell_partials(block, total, int(v[0]), counts, now[1] == now[2]):
            out.add(now[0], names[i], names[j], value)

    for batch in batches:
        for lang, lo, hi, tb, kind, source, block, term, n, v in columns_of(
                batch, "lang", "lo", "hi", "tb", "kind", "source", "block", "term", "n", "v"):
            if (lang, lo, hi, tb) != now:
                settle()
                groups, facts, terms, found, now = {}, [], {}, [], (lang, lo, hi, tb)
                if out.full():
                    yield out.take()
            if kind == 0:
                groups[source] = len(groups)
                facts.append((block, n, v))
            else:
                found.append((groups[source], terms.setdefault(term, len(terms)), n))
    settle()
    if len(out):
        yield out.take()


def kept_counts(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, lang_n, first), saved: the counts of the terms
    that are kept; ``first`` marks one row a term of the language."""
    workers(rows.sparkSession)
    counts = (rows.mapInArrow(term_counts, COUNTS).groupBy("lang", "source", "term")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    one = Window.partitionBy("lang", "term")  # a row a source
    seen = counts.select("lang", "source", "term", "n", F.sum("docs").over(one).alias("df"),
                         F.sum("n").over(one).alias("lang_n"),
                         (F.col("source") == F.min("source").over(one)).cast("long").alias("first"))
    return saved(seen.where(F.col("df") >= LEAST_DOCS).drop("df"), "cube-counts")


def with_groups(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One row a group, saved: its total, its kept terms, and of its language the
    total, the number of kept terms, and the blocks of groups and of terms."""
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("v"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    every = rows.select("lang", "source").distinct()
    many = saved(every.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(langs, "lang", "left"), "cube-langs")
    out = lookup_join(every.join(own, ["lang", "source"], "left"), many, "lang", "groups", "inner")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("total", "terms", "lang_total", "v")}
    return saved(out.withColumns(zero).withColumns({
        "blocks": F.ceil(F.col("groups") / GROUPS), "tbs": F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") / TERMS)),
    }).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))), "cube-groups")


def ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                        F.row_number().over(order).alias("rank"))


def pair_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of every group from every other of its language."""
    cell = ["lang", "lo", "hi", "tb"]
    cols = [*cell, "kind", "source", "block", "term", "n", "v"]
    every = groups.withColumn("tb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tbs") - 1)))
    own = groups.select("lang", "source", "terms", "block", "blocks", "tbs")
    placed = (lookup_join(kept, own, ["lang", "source"], "terms", "inner")
              .withColumn("tb", F.pmod(F.xxhash64("term"), F.col("tbs"))))
    sizes = placed.groupBy("lang", "tb").agg(F.sum("first").alias("cell_terms"))
    heads = every.join(sizes, ["lang", "tb"], "left").select(
        "lang", "tb", F.lit(0).alias("kind"), "source", "block", "blocks", F.lit(None).cast("string").alias("term"),
        (F.col("total") + F.col("v")).alias("n"), F.coalesce("cell_terms", F.lit(0).cast("long")).alias("v"))
    slices = placed.select("lang", "tb", F.lit(1).alias("kind"), "source", "block", "blocks", "term", "n",
                           F.lit(0).cast("long").alias("v"))
    sent = (heads.union(slices)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).select(*cols))
    partials = sent.repartition(*cell).sortWithinPartitions(*cell, "kind").mapInArrow(cells, PARTIAL)
    return partials.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms more frequent in a group than in its language."""
    own = groups.select("lang", "source", "terms", "total", "lang_total", "v")
    both = lookup_join(kept, own, ["lang", "source"], "terms", "inner").where("n > 0")
    p, q = share(F.col("n"), F.col("total") + F.col("v")), share(F.col("lang_n"), F.col("lang_total") + F.col("v"))
    both = both.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    return both.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, all ranks, and part ``term``, the first ``RANKS``."""
    rows = docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of().alias("text"))
    kept = kept_counts(rows)
    groups = with_groups(rows, kept)
    pairs = ranked(pair_values(kept, groups), "pair")
    return pairs.union(ranked(term_values(kept, groups), "term").where(F.col("rank") <= RANKS))


SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER.decode()}', '{UPPER.decode().lower()}'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
u AS (SELECT rid, lang, source, unnest(words) AS term FROM t),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT rid) AS docs FROM u GROUP BY lang, source, term),
k AS (SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY lang, term HAVING sum(docs) >= {LEAST_DOCS}),
l AS (SELECT lang, sum(lang_n) AS total, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT t.lang, t.source, coalesce(any_value(l.total), 0) AS lang_total, coalesce(any_value(l.v), 0) AS v
      FROM t LEFT JOIN l ON t.lang = l.lang GROUP BY t.lang, t.source),
kc AS (SELECT c.lang, c.source, c.term, c.n FROM c JOIN k ON c.lang = k.lang AND c.term = k.term),
gt AS (SELECT g.*, coalesce(s.total, 0) AS total FROM g LEFT JOIN
       (SELECT lang, source, sum(n) AS total FROM kc GROUP BY lang, source) s ON g.lang = s.lang AND g.source = s.source),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(kc.n, 0) AS n,
             1 + 1000000000::HUGEINT * (coalesce(kc.n, 0) + 1) // (gt.total + gt.v) AS p,
             1 + 1000000000::HUGEINT * (k.lang_n + 1) // (gt.lang_total + gt.v) AS q
      FROM gt JOIN k ON gt.lang = k.lang LEFT JOIN kc ON kc.lang = gt.lang AND kc.source = gt.source AND kc.term = k.term),
d AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= {RANKS}
"""
