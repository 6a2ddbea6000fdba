"""Near-duplicates by a multi-index Hamming join over b-bit MinHash signatures.

A document's set holds its distinct word shingles. Equal sets are one class; a
class has a signature of 65 positions of 16 bits, cut into 13 chunks of 5. Two
signatures that differ in at most 25 positions have, by the pigeonhole
principle, a chunk in which they differ in one position or none. So every
class is listed, for every chunk, under what is left of the chunk without each
of its positions (65 keys): all pairs within 25 positions share a key, and most
beyond do. (Of sets of similarity 0.8 one pair in 6,000 is further apart, and
fewer than one in 10 million shares no key.)

Classes under one key are candidates. They are linked in two passes:

1. Every key names a hub, its member with the least hash for the key's chunk
   (so a large group meets about 13 hubs), and every member is held against it.
   Confirmed links are contracted to components.
2. Keys whose members are in several components still: all their pairs of
   different components are held against each other, in blocks of ``BLOCK``
   members a task; only the pairs that may be links leave the task.

A pair is first held against an exact bound: the parity bitmaps of two sets
differ in at most as many bits as the sets in members. Those left are confirmed
on the full sets, made again from the texts of the classes concerned. Sets are
64-bit hashes of shingles; classes are told apart by 128 bits of the whole set.

Copies are one class, whatever their number, and pairs with a hub are dealt out
by hub and by ``PAIRS`` members. Components are found by alternating stars.

Null and blank texts have no set and are linked with nothing (each is its own
component); with fewer words than a shingle the whole sequence is the one
member. Rows of one class are linked. Null ids: never the smallest, so the
component is null only if no row of it has an id; such rows are kept if it is
null. Repeated rows all appear, with one verdict. Other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import minhash_sets as M
from .common import Rows, columns_of, id_text, lookup_join, saved, workers
from .components import components

#: Members held against one hub, and members of a key in one block, in a task.
PAIRS, BLOCK = 1000, 512
#: Repeated keys grow with the corpus: beyond so many (and so many hot ones) they are joined, not broadcast.
FEW_KEYS = 1000

DIGEST = "doc_id long, n_shingles long, c1 long, c2 long, sig binary, bits binary"
DIGEST_ARROW = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
                          ("sig", pa.binary()), ("bits", pa.binary())])
KEYS = "slot int, key long, cls long, n_shingles long"
KEYS_ARROW = pa.schema([("slot", pa.int32()), ("key", pa.int64()), ("cls", pa.int64()), ("n_shingles", pa.int64())])
SET = "cls long, n_shingles long, payload binary"
SET_ARROW = pa.schema([("cls", pa.int64()), ("n_shingles", pa.int64()), ("payload", pa.binary())])
PAIR = "a long, b long"
PAIR_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def sizes_allow(a, b):
    """Sets of these sizes may be linked (columns or arrays)."""
    return (5 * a >= 4 * b) & (5 * b >= 4 * a)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = M.common(a, b)
    return 100 * both >= 80 * (len(a) + len(b) - both)


def bits_allow(bits: bytes, n: int, others: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Which of the others may be linked with a set: two linked sets differ in
    a ninth of their sizes' sum at most."""
    out, own = np.zeros(len(others), bool), np.frombuffer(bits, np.uint8)
    lengths = np.array([len(x) for x in others])
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        rows = np.frombuffer(b"".join(others[k] for k in at.tolist()), np.uint8).reshape(len(at), size)
        if size > len(own):
            rows = np.bitwise_xor.reduce(rows.reshape(len(at), -1, len(own)), axis=1)
        out[at] = 9 * M.apart(own, rows) <= sizes[at] + n
    return out


# --- inside tasks ---------------------------------------------------------------------
def digest_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    out = Rows(DIGEST_ARROW)

    def flush(ids: list, texts: list[bytes]) -> None:
        sets = M.shingle_sets(texts, n)
        sigs = iter(M.signatures([s for s in sets if len(s)]))
        for i, s in zip(ids, sets, strict=True):
            if len(s):
                out.add(i, len(s), *M.fingerprint(s), next(sigs).tobytes(), M.bitmap(s), weight=500)
            else:
                out.add(i, 0, None, None, None, None)

    for batch in batches:
        ids, texts, size = [], [], 0
        for i, t in columns_of(batch, "doc_id", "text", raw=("text",)):
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= M.BATCH_BYTES:
                flush(ids, texts)
                ids, texts, size = [], [], 0
                if out.full():
                    yield out.take()
        if ids:
            flush(ids, texts)
        if len(out):
            yield out.take()


def sigs_of(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), M.POSITIONS)


def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    slots = np.arange(M.POSITIONS, dtype=np.int32)
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            cls, n, sig = (part.column(part.schema.get_field_index(c)) for c in ("cls", "n_shingles", "sig"))
            keys = M.chunk_keys(sigs_of(sig.to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(slots, len(keys))), pa.array(keys.ravel()),
                 pa.array(np.repeat(cls.to_numpy(zero_copy_only=False), M.POSITIONS)),
                 pa.array(np.repeat(n.to_numpy(zero_copy_only=False), M.POSITIONS))], schema=KEYS_ARROW)


def set_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The full sets of texts whose set is the class's (an id may stand on several texts)."""
    for batch in batches:
        rows, out = list(columns_of(batch, "cls", "c1", "c2", "text", raw=("text",))), Rows(SET_ARROW)
        sets = (s for lo in range(0, len(rows), 200) for s in M.shingle_sets([r[3] for r in rows[lo:lo + 200]], n))
        for (cls, c1, c2, _), s in zip(rows, sets, strict=True):
            if len(s) and M.fingerprint(s) == (c1, c2):
                out.add(cls, len(s), s.tobytes(), weight=8 * len(s))
                if out.full():
                    yield out.take()
        if len(out):
            yield out.take()


def held_against_hub(batches: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
    """Rows come by (a, salt), the hub's own first."""
    hub, hub_n, hub_key = b"", 0, None
    for batch in batches:
        out, waiting = Rows(PAIR_ARROW), []

        def settle() -> None:
            if waiting:
                ok = bits_allow(hub, hub_n, [w[2] for w in waiting], np.array([w[1] for w in waiting]))
                for (b, _, _), good in zip(waiting, ok.tolist(), strict=True):
                    if good:
                        out.add(hub_key[0], b)
                waiting.clear()

        for a, salt, kind, cls, n, p in columns_of(batch, "a", "salt", "kind", "cls", "n_shingles", "payload"):
            if kind == 0:
                settle()
                hub, hub_n, hub_key = np.frombuffer(p, np.uint64) if full else p, n, (a, salt)
            elif not full:
                waiting.append((cls, n, p))
            elif linked(hub, np.frombuffer(p, np.uint64)):
                out.add(a, cls)
        settle()
        if len(out):
            yield out.take()


def cell_pairs(slot: int, cls: np.ndarray, label: np.ndarray, n: np.ndarray, block: np.ndarray, sigs: np.ndarray,
               bits: list[bytes]) -> Iterator[tuple[int, int]]:
    """Pairs of a cell that may be links: of different components and (in a
    cell of two blocks) different blocks, that meet under no earlier key."""
    keys = M.chunk_keys(sigs)
    for r in range(len(cls) - 1):
        ok = (label[r + 1:] != label[r]) & sizes_allow(n[r + 1:], n[r])
        if block[0] != block[-1]:
            ok &= block[r + 1:] != block[r]
        at = np.flatnonzero(ok) + r + 1
        if len(at):
            at = at[(keys[at] == keys[r]).argmax(1) == slot]
        if len(at):
            at = at[bits_allow(bits[r], n[r], [bits[k] for k in at.tolist()], n[at])]
        for k in at.tolist():
            yield int(cls[r]), int(cls[k])


def held_in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (slot, key, lo, hi), in a cell by block."""
    out, rows, now = Rows(PAIR_ARROW), [], None

    def settle() -> None:
        if len(rows) > 1:
            cls, label, n, block = (np.array([r[k] for r in rows], np.int64) for k in range(4))
            for pair in cell_pairs(now[0], cls, label, n, block, sigs_of([r[4] for r in rows]), [r[5] for r in rows]):
                out.add(*pair)

    for batch in batches:
        for slot, key, lo, hi, *rest in columns_of(batch, "slot", "key", "lo", "hi", "cls", "label", "n_shingles",
                                                   "block", "sig", "bits"):
            if (slot, key, lo, hi) != now:
                settle()
                rows, now = [], (slot, key, lo, hi)
            rows.append(rest)
        if out.full():
            yield out.take()
    settle()
    if len(out):
        yield out.take()


# --- plans ----------------------------------------------------------------------------
def classes_of(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(one row a document, one row a class), both saved."""
    workers(docs.sparkSession)
    digests = saved(id_text(docs).mapInArrow(partial(digest_rows, n=n), DIGEST), "minhash-digests")
    one = digests.where("n_shingles > 0").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"), F.first("bits").alias("bits"))
    # numbered as they are written, and never again
    return digests, saved(one.withColumn("cls", F.monotonically_increasing_id()), "minhash-classes")


def held_by_hub(pairs: DataFrame, payload: DataFrame, full: bool) -> DataFrame:
    """The pairs whose payloads (cls, n_shingles, payload) allow a link. Of a
    pair the class with more pairs is the hub ``a``: its payload is sent once
    for ``PAIRS`` others."""
    degree = saved(pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls")
                   .agg(F.count(F.lit(1)).alias("n")), "minhash-degrees")
    both = pairs
    for end in ("a", "b"):
        own = degree.select(F.col("cls").alias(end), F.col("n").alias(f"n{end}"))
        both = lookup_join(both, own, end, f"n{end}", "inner")
    turn = F.struct("na", "a") >= F.struct("nb", "b")
    both = saved(both.select(F.when(turn, F.col("a")).otherwise(F.col("b")).alias("a"),
                             F.when(turn, F.col("b")).otherwise(F.col("a")).alias("b")), "minhash-pairs")
    per = saved(both.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "minhash-hubs")
    salts = F.floor(F.col("n") / PAIRS)
    cols = ["a", "salt", "kind", "cls", "n_shingles", "payload"]
    members = (lookup_join(both, per, "a", "n", "inner")
               .select("a", F.col("b").alias("cls"), F.pmod(F.xxhash64("b"), salts + 1).alias("salt"))
               .join(payload, "cls").withColumn("kind", F.lit(1)).select(*cols))
    hubs = (per.select("a", F.col("a").alias("cls"), F.explode(F.sequence(F.lit(0).cast("long"), salts)).alias("salt"))
            .join(payload, "cls").withColumn("kind", F.lit(0)).select(*cols))
    dealt = hubs.union(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return dealt.mapInArrow(partial(held_against_hub, full=full), PAIR)


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cls, n_shingles, payload): the sets of the wanted classes, from one text of each."""
    who = saved(classes.join(wanted, "cls", "left_semi").select(
        "cls", "c1", "c2", F.col("rep").isNull().alias("null_id"), F.coalesce("rep", F.lit(0)).alias("id"),
        F.lit(1).alias("size")), "minhash-wanted")
    texts = id_text(docs).select(F.col("doc_id").isNull().alias("null_id"),
                                 F.coalesce("doc_id", F.lit(0)).alias("id"), "text")
    found = lookup_join(texts, who, ["null_id", "id"], "size", "inner")
    # repeated rows are combined where they are read
    once = found.groupBy("cls", "c1", "c2", F.xxhash64("text").alias("_mark")).agg(F.first("text").alias("text"))
    sets = once.mapInArrow(partial(set_rows, n=n), SET)
    return saved(sets.dropDuplicates(["cls"]), "minhash-sets")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """The pairs that are links by their full sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    return saved(held_by_hub(pairs, full_sets(docs, classes, wanted, n), full=True), "minhash-links")


def class_links(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(a, b): links between classes, enough to connect all that are linked."""
    keys = classes.select("cls", "n_shingles", "sig").mapInArrow(key_rows, KEYS)
    again = saved(keys.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-keys")
    live = saved(lookup_join(keys, again, ["slot", "key"], "n", "inner", limit=FEW_KEYS), "minhash-members")
    # first pass: every member of a key against the key's hub
    rank = F.struct(F.xxhash64(F.floor(F.col("slot") / M.WIDTH), F.col("cls")).alias("r"), "cls", "n_shingles")
    hubs = saved(live.groupBy("slot", "key").agg(F.min(rank).alias("hub"), F.count(F.lit(1)).alias("m"))
                 .select("slot", "key", "m", F.col("hub.cls").alias("hub"), F.col("hub.n_shingles").alias("hub_n")),
                 "minhash-key-hubs")
    pairs = (lookup_join(live, hubs, ["slot", "key"], "m", "inner")
             .where((F.col("hub") != F.col("cls")) & sizes_allow(F.col("hub_n"), F.col("n_shingles")))
             .select(F.greatest("hub", "cls").alias("a"), F.least("hub", "cls").alias("b")).distinct())
    bits = classes.select("cls", "n_shingles", F.col("bits").alias("payload"))
    likely = saved(held_by_hub(saved(pairs, "minhash-candidates"), bits, full=False), "minhash-likely")
    first = confirmed(docs, classes, likely, n)
    # second pass: what is in several components still
    labels = components(first).select(F.col("a").alias("cls"), F.col("b").alias("label"))
    own = (live.join(labels, "cls", "left")
           .withColumn("label", F.coalesce("label", "cls")))
    own = saved(own.select("slot", "key", "cls", "n_shingles", "label"), "minhash-labelled")
    several = saved(own.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("x"),
                                                   F.max("label").alias("y")).where("x < y")
                    .select("slot", "key", "m"), "minhash-several")
    members = lookup_join(own, several, ["slot", "key"], "m", "inner")
    blocks = F.floor((F.col("m") + BLOCK - 1) / BLOCK)
    members = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    cells = (members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .join(classes.select("cls", "sig", "bits"), "cls")
             .select("slot", "key", "lo", "hi", "cls", "label", "n_shingles", "block", "sig", "bits"))
    cells = cells.repartition("slot", "key", "lo", "hi").sortWithinPartitions("slot", "key", "lo", "hi", "block")
    rest = saved(cells.mapInArrow(held_in_cells, PAIR), "minhash-rest")
    return first.union(confirmed(docs, classes, rest, n))


def groups(docs: DataFrame, n: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    digests, classes = classes_of(docs, n)
    labels = components(class_links(docs, classes, n)).select(F.col("a").alias("cls"), F.col("b").alias("label"))
    labelled = saved(classes.select("cls", "c1", "c2", "rep", "copies").join(labels, "cls", "left")
                     .withColumn("label", F.coalesce("label", "cls")), "minhash-components")
    least = saved(labelled.groupBy("label").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members")),
                  "minhash-least")
    found = saved(lookup_join(labelled, least, "label", "members", "inner").select("c1", "c2", "copies", "component_id"),
                  "minhash-found")
    some = lookup_join(digests.where("n_shingles > 0").select("doc_id", "n_shingles", "c1", "c2"), found, ["c1", "c2"],
                       "copies", "inner").select("doc_id", "n_shingles", "component_id")
    none = digests.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
