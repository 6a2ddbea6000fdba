"""Which filter removes what, in every order, with duplicates found by radix tries.

Five filters judge whole texts: A too few words, B too few distinct words, C
too many capitals, D special characters, E the text of a smaller id. What they
remove depends on their order; the audit counts it for all 120 orders.

E is found by compressed tries over the full bytes of the texts, whose
terminals hold the minimum id:

1. Text space is cut into ranges, each of all texts with one prefix. A prefix
   has 4 bytes; where the texts of a prefix have more than ``CELL_BYTES`` in
   all, it is replaced by prefixes of 16 bytes, then 64, and so on, up to whole
   texts (whose copies are combined before they meet, so need no cut). The
   prefixes to replace, at most (bytes of all texts) / ``CELL_BYTES`` a length,
   are what the tasks are told.
2. Every task inserts its texts into a trie (a new one after ``HELD_BYTES``).
   A row whose text is there with a smaller id is a duplicate and needs its
   text no more; at the end one row a distinct text goes on with its text.
3. These are dealt out by range; the ranges of a task come one after another,
   a trie each, which is traversed at its end: who isn't at the minimum id of a
   terminal is a duplicate.

From there rows are ids with a mask of failed filters; labels join them, and they
are reduced to counts a part and mask (32 masks), from which all orders follow.
A third of all rows with one text cost one row a task each; one range holds
at most ``CELL_BYTES``, or copies of one text.

Null text and source are empty. A null id is no smaller id and never fails E.
Rows of equal id and text don't fail E because of each other. Labels that
repeat a document count once, as good (toxic) if any says so. Other columns are
not read. An empty table gives no rows; a part has all 600 rows, zeros included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rows, columns_of, lookup_join, saved, text_of, workers

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SPECIAL = 200, 50, 2, "#$%&*|"
FILTERS = "ABCDE"
A, B, C, D, E = (1 << k for k in range(5))
ORDERS = ["".join(p) for p in permutations(FILTERS)]

#: Bytes of text in a range, and in a task's own trie.
CELL_BYTES, HELD_BYTES = 32 << 20, 48 << 20
#: Lengths of prefixes; about so many bytes a text costs besides its own.
LENGTHS, NODE_BYTES = [4 << (2 * k) for k in range(14)], 700

MASKED = "doc_id long, part string, mask int, n long, cell long, text binary"
MASKED_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()),
                          ("cell", pa.int64()), ("text", pa.binary())])

CAPITALS, SPECIAL_BYTES, INNER = bytes(range(65, 91)), SPECIAL.encode(), bytes(range(0x80, 0xC0))


def failed(text: bytes) -> int:
    """The mask of filters A to D for a UTF-8 text."""
    words = text.split()
    points = len(text.translate(None, INNER))
    return ((A if len(words) < LEAST_WORDS else 0)
            | (B if 100 * len(set(words)) < LEAST_DISTINCT * len(words) else 0)
            | (C if 100 * (len(text) - len(text.translate(None, CAPITALS))) > MOST_CAPITALS * points else 0)
            | (D if len(text.translate(None, SPECIAL_BYTES)) < len(text) else 0))


class Node:
    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, None, None, None


def shared(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of ``label`` stand in ``text`` from ``at`` on."""
    done, step, most = 0, 64, min(len(label), len(text) - at)
    while done < most:
        end = min(most, done + step)
        if label[done:end] == text[at + done:at + end]:
            done, step = end, 2 * step
        elif end - done == 1:
            break
        else:
            step = (end - done) // 2
    return done


class Trie:
    """A compressed trie of texts. A terminal holds the least id of its text
    and the rows with that id: (part, mask) and their number."""

    def __init__(self):
        self.top, self.bytes = Node(b""), 0

    def terminal(self, text: bytes) -> Node:
        node, at = self.top, 0
        while at < len(text):
            child = node.children and node.children.get(text[at])
            if not child:
                child = Node(text[at:])
                self.bytes += len(text) - at + NODE_BYTES
                node.children = node.children or {}
                node.children[text[at]] = child
                return child
            if not text.startswith(child.label, at):
                cut = shared(child.label, text, at)
                upper = Node(child.label[:cut])
                child.label = child.label[cut:]
                upper.children = {child.label[0]: child}
                node.children[text[at]] = upper
                self.bytes += NODE_BYTES
                child = upper
            at += len(child.label)
            node = child
        return node

    def add(self, text: bytes, i: int, row: tuple, n: int) -> tuple[int, dict] | None:
        """Insert; gives back (id, rows) of what is now known to be a duplicate."""
        node = self.terminal(text)
        if node.least is None or i < node.least:
            before = None if node.least is None else (node.least, node.rows)
            node.least, node.rows = i, {row: n}
            return before
        if i > node.least:
            return i, {row: n}
        node.rows[row] = node.rows.get(row, 0) + n
        return None

    def texts(self) -> Iterator[tuple[bytes, int, dict]]:
        """(text, least id, rows) of every terminal."""
        waiting = [(self.top, b"")]
        while waiting:
            node, before = waiting.pop()
            text = before + node.label
            if node.least is not None:
                yield text, node.least, node.rows
            waiting += ((c, text) for c in (node.children or {}).values())


def cell_of(text: bytes, heavy: frozenset[tuple[int, int]]) -> int:
    """The hash of the text's prefix that isn't replaced by longer ones."""
    for k, length in enumerate(LENGTHS):
        own = xxhash.xxh64_intdigest(text[:length], seed=42)
        own -= (own >> 63) << 64
        if length >= len(text) or (k, own) not in heavy:
            return own
    return own


def local_tries(batches: Iterator[pa.RecordBatch], heavy: frozenset[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Step 2. Rows whose text is null are decided."""
    trie, out, without_id = Trie(), Rows(MASKED_ARROW), Counter()

    def candidates() -> Iterator[pa.RecordBatch]:
        for text, i, rows in trie.texts():
            cell = cell_of(text, heavy)
            for (part, mask), n in rows.items():
                out.add(i, part, mask, n, cell, text, weight=len(text))
            if out.full():
                yield out.take()

    for batch in batches:
        for i, part, text in columns_of(batch, "doc_id", "part", "text", raw=("text",)):
            mask = failed(text)
            if i is None:
                without_id[part, mask] += 1
                continue
            gone = trie.add(text, i, (part, mask), 1)
            for (p, m), n in gone[1].items() if gone else ():
                out.add(gone[0], p, m | E, n, gone[0] * 0x9E3779B97F4A7C15 % (1 << 62), None)
            if out.full():
                yield out.take()
            if trie.bytes >= HELD_BYTES:
                yield from candidates()
                trie = Trie()
    yield from candidates()
    for (part, mask), n in without_id.items():
        out.add(None, part, mask, n, n, None)
    if len(out):
        yield out.take()


def range_tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: rows come by cell. Gives decided rows."""
    trie, out, now = Trie(), Rows(MASKED_ARROW), None

    def put(i: int, rows: dict, more: int) -> None:
        for (part, mask), n in rows.items():
            out.add(i, part, mask | more, n, None, None)

    def traversed() -> Iterator[pa.RecordBatch]:
        for _, i, rows in trie.texts():
            put(i, rows, 0)
            if out.full():
                yield out.take()

    for batch in batches:
        for i, part, mask, n, cell, text in columns_of(batch, "doc_id", "part", "mask", "n", "cell", "text"):
            if text is None:
                out.add(i, part, mask, n, None, None)
            else:
                if cell != now:
                    yield from traversed()
                    trie, now = Trie(), cell
                gone = trie.add(text, i, (part, mask), n)
                if gone:
                    put(*gone, E)
            if out.full():
                yield out.take()
    yield from traversed()
    if len(out):
        yield out.take()


def heavy_prefixes(rows: DataFrame) -> frozenset[tuple[int, int]]:
    """(number of the length, hash) of the prefixes that are replaced by longer
    ones. One pass over the texts leaves a row's hashes of all its prefixes;
    the rounds, one a length, read those of the prefixes replaced so far."""
    raw = F.col("text").cast("binary")
    lengths = F.filter(F.array(*map(F.lit, LENGTHS)), lambda x: (x == LENGTHS[0]) | (x < 4 * F.length(raw)))
    hashes = saved(rows.select((F.length(raw) + NODE_BYTES).alias("bytes"), F.transform(
        lengths, lambda x: F.xxhash64(F.substring(raw, F.lit(1), x))).alias("h")), "trie-prefixes")
    heavy: set[tuple[int, int]] = set()
    here = hashes
    for k in range(len(LENGTHS) - 1):
        own = F.get("h", F.lit(k))
        # a prefix that is the whole text can't be replaced
        found = saved(here.where(F.size("h") > k + 1).groupBy(own.alias("own")).agg(F.sum("bytes").alias("size"))
                      .where(F.col("size") > CELL_BYTES), "trie-heavy")
        now = {(k, r.own) for r in found.select("own").collect()}
        if not now:
            break
        heavy |= now
        here = lookup_join(here.withColumn("own", own), found, "own", "size", "inner").select("bytes", "h")
    return frozenset(heavy)


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): ids with their failed filters."""
    workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("source").alias("part"),
                       text_of().alias("text"))
    first = rows.mapInArrow(partial(local_tries, heavy=heavy_prefixes(rows)), MASKED)
    dealt = first.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(range_tries, MASKED).select("doc_id", "part", "mask", "n")


def reduced(masked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic), at most 32 rows a part."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    both = masked.join(marks, "doc_id", "left")
    return both.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *(F.sum(F.coalesce(c, F.lit(0).cast("long")) * F.col("n")).alias(c) for c in ("good", "toxic")))


def bits(letters: Column) -> Column:
    out = F.lit(0)
    for k, f in enumerate(FILTERS):
        out = out + F.when(F.contains(letters, F.lit(f)), F.lit(1 << k)).otherwise(F.lit(0))
    return out


def by_order(counts: DataFrame) -> DataFrame:
    """One row a part, order of the filters and step."""
    rows = (counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
            .withColumns({"own": bits(F.substring("filter_order", F.col("step"), F.lit(1))),
                          "before": bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))}))
    m, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, earlier = m.bitwiseAND(own) != 0, m.bitwiseAND(before) != 0
    total = lambda when, what: F.sum(F.when(when, what).otherwise(F.lit(0).cast("long"))).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier, F.col("n")).alias("kept"), total(fails & ~earlier, F.col("n")).alias("removed"),
        total(fails & earlier, F.col("n")).alias("redundant"), total(m == own, F.col("n")).alias("unique_fails"),
        total(fails & ~earlier, F.col("good")).alias("good_lost"),
        total(fails & ~earlier, F.col("toxic")).alias("toxic_lost"),
        # of a row's failed filters each comes first in an equal share of the orders
        total(fails, F.col("n") * F.call_function("div", F.lit(len(ORDERS)), F.bit_count(m))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return by_order(saved(reduced(masks(docs), labels), "filter-masks"))


SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS again FROM documents),
m AS (SELECT doc_id, part, (len(words) < {LEAST_WORDS})::INT
             + 2 * (100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words))::INT
             + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(text))::INT
             + 8 * regexp_matches(text, '[{SPECIAL}]')::INT + 16 * again::INT AS mask FROM t),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM m LEFT JOIN g USING (doc_id) GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT [v.f, w.f, x.f, y.f, z.f] AS fs, [v.b, w.b, x.b, y.b, z.b] AS bs FROM f v, f w, f x, f y, f z
      WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5),
s AS (SELECT array_to_string(fs, '') AS filter_order, step, bs[step] AS own, coalesce(list_sum(bs[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step))
SELECT part, filter_order, step::INTEGER AS step,
       coalesce(sum(n) FILTER (WHERE mask & (own | before) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(1, bit_count(mask))) FILTER (WHERE mask & own <> 0), 0)::BIGINT AS shapley
FROM c, s GROUP BY part, filter_order, step
"""
