"""SimHash near-duplicates found with BK-trees.

A document's 64-bit fingerprint has a bit set where more than half of its
shingles' XXH64 values have it. Equal fingerprints are one node. Two nodes link
at ``radius`` (2) or fewer differing bits; a document's group is the set of all
reachable ones.

Shards: the 64 bits are cut into four blocks of 16. Fingerprints within 2 bits
agree in at least two blocks, so each of the six pairs of blocks deals the
nodes into shards by those 32 bits, and every link lies inside a shard. A task
holds the shards of its partition, builds each one's BK-tree (children keyed by
their integer Hamming distance to the parent) and looks each member up in it,
following only edges within the radius of the distance to the node (triangle
inequality). Trees meet their queries by the shuffle on the shard, since a
broadcast of all trees would grow with the corpus. Links that join nothing new
in their shard are not given out.

A shard of more than ``MOST`` members (very many near copies of one text) isn't
put in one tree. Its members go the exact way for the rest: each is listed
under itself and its 64 neighbours at one bit, and two members within 2 bits
meet under a neighbour they share. At most 65 members can meet there.

Null text is an empty text. No words: fingerprint zero, linked like any other.
Fewer words than a shingle: one shingle of all. A null id belongs to its group
and is never its smallest id, unless there is no other. Repeated rows are all
returned. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rows, columns_of, id_text, leave_out, lookup_join, saved, text_of, workers
from .components import components

#: Members of a shard that share a tree.
MOST = 256
#: Shingles hashed at once.
STEP = 100_000
PRINTS_ARROW = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("fp", pa.int64())])
LINKS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(words: list[bytes], n: int) -> Iterator[list[bytes]]:
    """Space-joined shingles, repeats included, in lists of bounded length."""
    if len(words) < n:
        if words:
            yield [b" ".join(words)]
        return
    for k in range(0, len(words) - n + 1, STEP):
        own = words[k:k + STEP + n - 1]
        yield list(map(b" ".join, zip(*(own[i:] for i in range(n)), strict=False)))


def fingerprint(text: bytes, n: int, seed: int) -> int:
    """The fingerprint of a text in UTF-8, unsigned."""
    from xxhash import xxh64_intdigest

    ones, total = np.zeros(64, np.int64), 0
    for part in shingles(text.lower().split(), n):  # bytes.lower() and split() know ASCII only
        h = np.array([xxh64_intdigest(s, seed) for s in part], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def print_rows(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[pa.RecordBatch]:
    rows = Rows(PRINTS_ARROW)
    for batch in batches:
        for doc_id, mark, text in columns_of(batch, "doc_id", "mark", "text", raw=("text",)):
            fp = fingerprint(text, n, seed)
            rows.add(doc_id, mark, fp - (1 << 64) if fp >> 63 else fp)
        yield rows.take()


def fingerprints(docs: DataFrame, n: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, mark, fp): ``fp`` has the unsigned fingerprint's bits as a
    long, ``mark`` is a hash of the text that tells rows with one id apart."""
    workers(docs.sparkSession)
    marked = id_text(docs).withColumn("mark", F.xxhash64("text"))
    return marked.mapInArrow(partial(print_rows, n=n, seed=seed), "doc_id long, mark long, fp long")


class BKTree:
    """Distinct integers under the Hamming distance. A node is (value, {distance: child})."""

    def __init__(self):
        self.root: tuple[int, dict] | None = None

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [self.root] if self.root else []
        while todo:
            own, children = todo.pop()
            d = (own ^ value).bit_count()
            if d <= radius:
                found.append(own)
            if children:
                todo += [children[k] for k in range(max(1, d - radius), d + radius + 1) if k in children]
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        own, children = self.root
        while d := (own ^ value).bit_count():
            if d not in children:
                children[d] = (value, {})
                return
            own, children = children[d]


def shard_links(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links of one shard, without those inside a group that links found before already join."""
    top = {m: m for m in members}

    def group(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    tree = BKTree()
    for m in members:
        for other in tree.within(m, radius):
            a, b = group(m), group(other)
            if a != b:
                top[a] = b
                yield m, other
        tree.add(m)


def links_of_shards(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, fp) come sorted by shard."""
    rows, now, members = Rows(LINKS_ARROW), None, []

    def close():
        if len(members) > 1:
            for a, b in shard_links(members, radius):
                rows.add(a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b)

    for batch in batches:
        shard = batch.column(0).to_numpy()
        fp = batch.column(1).to_numpy().view(np.uint64)
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            if shard[i] != now:
                close()
                now, members = shard[i], []
            members += fp[i:j].tolist()
        if rows.full():
            yield rows.take()
    close()
    if len(rows):
        yield rows.take()


def links(nodes: DataFrame, radius: int = 2, most: int = MOST) -> DataFrame:
    """(a, b): links that join the same nodes as all pairs of the distinct
    ``nodes`` (fp) within ``radius`` bits. The radius is at most 2 here: two of
    four blocks agree only up to there."""
    if not 0 <= radius <= 2:
        raise ValueError("a radius of 0 to 2 bits")
    block = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    keys = [F.lit(t << 32).cast("long") + F.shiftleft(block[i], 16) + block[j]
            for t, (i, j) in enumerate(combinations(range(4), 2))]
    dealt = nodes.select("fp", F.explode(F.array(*keys)).alias("shard"))
    sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = saved(sizes, "simhash-shards")
    shared = lookup_join(dealt, sizes, "shard", "n", "inner")
    found = (shared.where(F.col("n") <= most).select("shard", "fp").repartition("shard")
             .sortWithinPartitions("shard", "fp")
             .mapInArrow(partial(links_of_shards, radius=radius), "a long, b long"))
    return found.union(ball_links(shared.where(F.col("n") > most).select("fp").distinct(), radius))


def ball_links(nodes: DataFrame, radius: int) -> DataFrame:
    """All members listed under themselves and, for a radius of 2, their 64
    neighbours at one bit; those under the same value are within 2 bits of
    each other. For a radius of 1 a link needs the member that is the value itself."""
    if not radius:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    near = F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), k) for k in range(64)))
    listed = nodes.select("fp", F.explode(near).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    first = F.min("fp") if radius == 2 else F.min(F.when(F.col("fp") == F.col("at"), F.col("fp")))
    met = listed.groupBy("at").agg(first.alias("a"), F.collect_set("fp").alias("all"))  # 65 at most
    return met.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a != b")


def groups(docs: DataFrame, n: int = 3, radius: int = 2, seed: int = 42, most: int = MOST) -> DataFrame:
    """(doc_id, mark, fp, component_id) of every document."""
    prints = saved(fingerprints(docs, n, seed), "simhash-prints")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius, most)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    # fingerprints that more than one document has or that link; a root has no row of its own in ``roots``
    root = roots.select(F.col("root").alias("fp"), F.col("root").alias("own")).distinct()
    rooted = (nodes.join(roots, "fp", "left").join(root, "fp", "left")
              .withColumn("root", F.coalesce("root", "own", F.when(F.col("n") > 1, F.col("fp")))).where("root is not null"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id", "n")
    found = lookup_join(prints, saved(by_print, "simhash-groups"), "fp", "n")
    return found.select("doc_id", "mark", "fp", F.when(F.col("n").isNull(), F.col("doc_id"))
                        .otherwise(F.col("component_id")).alias("component_id"))


def hex_digits(fp: Column) -> Column:
    """16 lower-case hexadecimal digits of a long's bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def first_of_groups(docs: DataFrame, n: int = 3, radius: int = 2) -> DataFrame:
    """The documents without those whose group has a smaller id, with all their
    columns. A document with a null id stays only in a group without any other
    id; rows that repeat the smallest id all stay."""
    found = groups(docs, n, radius)
    return leave_out(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))), F.xxhash64(text_of()))
