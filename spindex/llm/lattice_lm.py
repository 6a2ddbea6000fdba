"""Document scores of a subword lattice.

A text is its words and the end. The lattice of a word (with the space before
it) has an arc for every piece of an existing byte-level vocabulary that stands
somewhere in it, and, if the training texts have the word, one arc over all of
it: the training words are long pieces, whose table grows with the corpus. All
segmentations are weighed by unigram scores: a forward recursion in log space
over the word's bytes sums them, so a text's score is its marginal log10
probability under the model, not that of one best segmentation. Pieces never
cross white space, so a text's lattice is the product of its words' lattices
and the end. Every byte is a piece: no word has probability zero.

Scores: a training word's arc has its count less an absolute discount, which is
n1 / (n1 + 2 n2) of the numbers n1, n2 of words seen once and twice. What the
discounts leave goes to spelling: a piece with a space first, then pieces
without, then a stop. The vocabulary's file has no probabilities, so the pieces
get theirs from the lattice itself: from the tokenizer's own segmentation of the
distinct training words (an unseen word is like a word seen once, not like a
common one), ``ROUNDS`` rounds of expected uses, forward and backward over all
segmentations of every distinct training word, each add-half smoothed. All words
and the end sum to one at most (pieces that hold more white space are never used).

The lattice of a word is computed once. Word counts (which grow with the
corpus) are one shuffled table; a text's score is a join of its words with it.
The commonest words (at most ``HOT``, each by a key of at most ``LONGEST`` bytes,
so a table of bounded size) are broadcast and added up where the text is read;
only the others move, once a text and word.

Training texts are those whose crc32(id as text) mod 5 is not 1; a null id
counts as the empty text (mod 0: training). Null text is an empty text (the end
alone). Repeated rows are scored one by one and all count for training. Other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Rows, columns_of, crc_of_id, id_text, saved, workers
from .token_ids import encoder

HOT, LONGEST = 200_000, 48
FOLDS, HELD_OUT = 5, 1
#: Rounds of expected uses; these are counted in whole numbers of 1 / UNIT, so sums don't depend on their order.
ROUNDS, UNIT = 2, 1 << 20
#: Words of one length that are taken through the lattice together.
TOGETHER = 4096
#: Distinct words that a task counts before it gives them out.
WAITING = 250_000
COUNTS = "k binary, word binary, c long"
COUNTS_ARROW = pa.schema([("k", pa.binary()), ("word", pa.binary()), ("c", pa.int64())])
PIECES_ARROW = pa.schema([("piece", pa.int32()), ("n", pa.int64())])
SCORED = "k binary, c long, lp double"
USES = "piece binary, n long"
USES_ARROW = pa.schema([("piece", pa.binary()), ("n", pa.int64())])
PARTS = ("row long, doc_id long, n_tokens long, k binary, tf long, base double, lattice double, known long")
PARTS_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("k", pa.binary()),
                         ("tf", pa.int64()), ("base", pa.float64()), ("lattice", pa.float64()), ("known", pa.int64())])


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case; bytes.lower() and split() know ASCII only."""
    return text.lower().split()


def key_of(word: bytes) -> bytes:
    """A word's key of bounded length: itself, or a space (which no word has) and its SHA-256."""
    return word if len(word) <= LONGEST else b" " + hashlib.sha256(word).digest()


def is_held_out(doc_id: int | None) -> bool:
    return crc_of_id(doc_id) % FOLDS == HELD_OUT


# -- counting --------------------------------------------------------------
def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of every word read; words of held-out texts alone count 0."""
    counts, others = Counter(), set()

    def out():
        rows = Rows(COUNTS_ARROW)
        for w in others:
            counts[w] += 0
        for w, c in counts.items():
            rows.add(key_of(w), None if len(w) <= LONGEST else w, c, weight=len(w))
            if rows.full():
                yield rows.take()
        yield rows.take()
        counts.clear()
        others.clear()

    for batch in batches:
        for doc_id, text in columns_of(batch, "doc_id", "text", raw=("text",)):
            (others if is_held_out(doc_id) else counts).update(words_of(text))
            if len(counts) + len(others) >= WAITING:
                yield from out()
    yield from out()


def spelt(word: bytes, letters: dict[int, str]) -> str:
    """A word with the space before it, in the vocabulary's letters."""
    return (b" " + word).decode("latin-1").translate(letters)


def count_pieces(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """How often the segmentations of the distinct words use each piece."""
    enc, total = encoder(path), Counter()
    for batch in batches:
        for k, word in columns_of(batch, "k", "word"):
            total.update(t.id for t in enc.tok.model.tokenize(spelt(k if word is None else word, enc.letters)))
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())],
                                         schema=PIECES_ARROW)


# -- the lattice -----------------------------------------------------------
def vocabulary(path: str) -> dict[int, bytes]:
    """Piece ids and their bytes, special tokens left out."""
    enc = encoder(path)
    back = {c: b for b, c in enc.letters.items()}
    special = set(enc.tok.get_added_tokens_decoder())
    return {i: bytes(back[c] for c in p) for p, i in enc.tok.get_vocab(with_added_tokens=False).items()
            if i not in special}


def scores(pieces: dict[int, bytes], counts: dict[int, float], words: int) -> tuple[dict[bytes, float], float]:
    """Natural log scores of the pieces and of the stop after a word's last
    one, from the segmentations of ``words`` words. Pieces with a space first
    begin a word, the others go on with it, so each kind sums to one (the
    others together with the stop)."""
    at = {p: counts.get(i, 0) + 0.5 for i, p in pieces.items()}
    first = sum(c for p, c in at.items() if p[0] == 32)
    later = sum(c for p, c in at.items() if p[0] != 32) + words + 0.5
    return {p: math.log(c / (first if p[0] == 32 else later)) for p, c in at.items()}, math.log((words + 0.5) / later)


class Model(NamedTuple):
    """Scores of the pieces (and their beginnings) and the stop, natural logs;
    the discount; distinct training words; training texts; training tokens
    with their ends."""
    tree: dict[bytes, float]
    stop: float
    discount: float
    words: int
    ends: int
    tokens: int

    def word(self, word: bytes, count: int) -> float:
        """log10 of a word's marginal probability; ``count`` is how often the training texts have it."""
        spelling = (math.log((self.discount * self.words + 0.5) / (self.tokens + 1))
                    + marginal(b" " + word, self.tree) + self.stop)
        if count <= self.discount:
            return spelling / math.log(10)
        whole = math.log((count - self.discount) / (self.tokens + 1))
        high, low = max(whole, spelling), min(whole, spelling)
        return (high + math.log1p(math.exp(low - high))) / math.log(10)

    def end(self) -> float:
        return math.log10((self.ends + 0.5) / (self.tokens + 1))


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once else 0.5


def prefixes(score: dict[bytes, float]) -> dict[bytes, float]:
    """Pieces with their scores, and beginnings of pieces with 0 (a score is below 0)."""
    out = {p[:k]: 0.0 for p in score for k in range(1, len(p))}
    return out | score


def forward(text: bytes, tree: dict[bytes, float]) -> list[float | None]:
    """log of the summed probability of all segmentations of each beginning of
    ``text`` (None: there is none): over its bytes, from each reached place
    along the pieces that begin there."""
    n = len(text)
    alpha: list[float | None] = [None] * (n + 1)
    alpha[0] = 0.0
    look, exp, log1p = tree.get, math.exp, math.log1p
    for i in range(n):
        here = alpha[i]
        if here is None:
            continue
        for j in range(i + 1, n + 1):
            p = look(text[i:j], 1.0)
            if p > 0:
                break
            if p < 0:
                new, old = here + p, alpha[j]
                if old is None:
                    alpha[j] = new
                elif old >= new:
                    alpha[j] = old + log1p(exp(new - old))
                else:
                    alpha[j] = new + log1p(exp(old - new))
    return alpha


def marginal(text: bytes, tree: dict[bytes, float]) -> float:
    """log of the summed probability of all segmentations of ``text``."""
    last = forward(text, tree)[-1]
    return -math.inf if last is None else last


def add_uses(text: bytes, tree: dict[bytes, float], uses: dict[bytes, int]) -> None:
    """Adds to ``uses`` how often a segmentation of ``text``, drawn by its
    probability, uses each piece on average. Log space, and nothing kept but a
    number a byte: for words of any length."""
    alpha = forward(text, tree)
    n, total = len(text), alpha[-1]
    if total is None:
        return
    beta: list[float | None] = [None] * n + [0.0]
    for i in range(n - 1, -1, -1):
        if alpha[i] is None:
            continue
        for j in range(i + 1, n + 1):
            p = tree.get(text[i:j], 1.0)
            if p > 0:
                break
            if p < 0 and beta[j] is not None:
                new, old = p + beta[j], beta[i]
                uses[text[i:j]] += round(math.exp(alpha[i] + new - total) * UNIT)
                beta[i] = new if old is None else max(old, new) + math.log1p(math.exp(-abs(old - new)))


class Net(NamedTuple):
    """The pieces and their beginnings as numbered states, 0 the empty one,
    those that go on first: the state after a byte (0: none), the pieces'
    probabilities (0 for beginnings) and the strings."""
    after: np.ndarray
    chance: np.ndarray
    names: list[bytes]


def net(tree: dict[bytes, float]) -> Net:
    go_on = {p[:-1] for p in tree} | {b""}
    names = sorted(go_on) + sorted(tree.keys() - go_on)  # the empty string sorts first
    number = {p: i for i, p in enumerate(names)}
    after = np.zeros((len(go_on), 256), np.int32)
    for p in tree:
        after[number[p[:-1]], p[-1]] = number[p]
    return Net(after, np.array([math.exp(tree[p]) if tree.get(p, 0.0) < 0 else 0.0 for p in names]), names)


def add_uses_many(words: list[bytes], net: Net, uses: np.ndarray) -> list[bytes]:
    """The same for many short words of one length at a time, by plain products;
    ``uses`` counts by state. Gives back the words whose probability is too
    small for that (nothing is added for them)."""
    m, n, last = len(words), len(words[0]), len(net.after)
    letters = np.ascontiguousarray(np.frombuffer(b"".join(words), np.uint8).reshape(m, n).T)
    alpha, beta, arcs = np.zeros((n + 1, m)), np.zeros((n + 1, m)), []
    alpha[0] = 1.0
    for i in range(n):
        at = np.flatnonzero(alpha[i])
        state = np.zeros(len(at), np.int32)
        for j in range(i, n):
            state = net.after[state, letters[j, at]]
            there = state > 0
            at, state = at[there], state[there]
            if not len(at):
                break
            p = net.chance[state]
            whole = p > 0
            words_at, pieces, p = at[whole], state[whole], p[whole]
            alpha[j + 1, words_at] += alpha[i, words_at] * p
            arcs.append((i, j + 1, words_at, pieces, p))
            deeper = state < last
            at, state = at[deeper], state[deeper]
    good = alpha[n] >= 1e-290
    beta[n, good] = UNIT / alpha[n, good]
    found, numbers = [], []
    for i, j, at, pieces, p in reversed(arcs):
        share = p * beta[j, at]
        beta[i, at] += share
        found.append(pieces)
        numbers.append(np.floor(alpha[i, at] * share + 0.5))
    if found:  # whole numbers far below 2 ** 53: the sum is exact
        uses += np.bincount(np.concatenate(found), np.concatenate(numbers), len(uses)).astype(np.int64)
    return [w for w, g in zip(words, good, strict=True) if not g]


def count_uses(batches: Iterator[pa.RecordBatch], tree) -> Iterator[pa.RecordBatch]:
    """Expected uses of each piece in the distinct words read, in 1 / UNIT.
    Short words wait by length until there are ``TOGETHER``."""
    states, uses, waiting = net(tree.value), defaultdict(int), defaultdict(list)
    counts = np.zeros(len(states.names), np.int64)

    def done(words):
        for w in add_uses_many(words, states, counts):
            add_uses(w, tree.value, uses)
        words.clear()

    for batch in batches:
        for k, word in columns_of(batch, "k", "word"):
            text = b" " + (k if word is None else word)
            if len(text) > LONGEST + 1:
                add_uses(text, tree.value, uses)
                continue
            group = waiting[len(text)]
            group.append(text)
            if len(group) >= TOGETHER:
                done(group)
    for group in waiting.values():
        if group:
            done(group)
    for i in np.flatnonzero(counts):
        uses[states.names[i]] += int(counts[i])
    if uses:
        yield pa.RecordBatch.from_arrays([pa.array(list(uses), pa.binary()), pa.array(list(uses.values()), pa.int64())],
                                         schema=USES_ARROW)


def score_words(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    known = Model(*model.value)
    for batch in batches:
        lp = [known.word(k if w is None else w, c) for k, w, c in columns_of(batch, "k", "word", "c")]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lp, pa.float64())],
                                         names=["k", "c", "lp"])


# -- texts -----------------------------------------------------------------
def read_texts(batches: Iterator[pa.RecordBatch], hot) -> Iterator[pa.RecordBatch]:
    """For each text one row with what its common words add up to, and a row
    for each other word. The text's own row has a key no word has."""
    keys, base, lattice, known = hot.value
    number = {k: i for i, k in enumerate(keys, 1)}
    base, lattice, known = (np.concatenate([[0.0], x]) for x in (base, lattice, known))
    rows, get = Rows(PARTS_ARROW), number.get
    for batch in batches:
        for row, doc_id, text in columns_of(batch, "row", "doc_id", "text", raw=("text",)):
            words = words_of(text)
            found = [get(w, 0) for w in words]
            if 0 in found:  # a long word is common by its key
                found = [i if i or len(w) <= LONGEST else get(key_of(w), 0) for w, i in zip(words, found, strict=True)]
            at = np.array(found, np.int64)
            rows.add(row, doc_id, len(words) + 1, b" " + row.to_bytes(8, "little"), 0, float(base[at].sum()),
                     float(lattice[at].sum()), int(known[at].sum()))
            if 0 in found:
                for k, tf in Counter(w if len(w) <= LONGEST else key_of(w)
                                     for w, i in zip(words, found, strict=True) if not i).items():
                    rows.add(row, None, 0, k, tf, 0.0, 0.0, 0)
            if rows.full():
                yield rows.take()
    if len(rows):
        yield rows.take()


def half(c: Column) -> Column:
    return F.log10(c + F.lit(0.5))


def score(docs: DataFrame, path: str, hot: int = HOT, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    workers(spark)
    texts = id_text(docs)
    counted = (texts.mapInArrow(count_words, COUNTS).groupBy("k", "word").agg(F.sum("c").alias("c")))
    counted = saved(counted, "lm-counts")

    # one row each: the training corpus' size, and the scores of the vocabulary's pieces
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    ends = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(fold != HELD_OUT).count()
    n, v, once, twice = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1)),
        F.count(F.when(F.col("c") == 2, 1))).first()
    used = (counted.where("c > 0").mapInArrow(partial(count_pieces, path=path), "piece int, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")).collect())  # a row for each piece of the vocabulary at most
    pieces = vocabulary(path)
    known, stop = scores(pieces, {r.piece: r.n for r in used}, v)
    ids = {p: i for i, p in pieces.items()}
    for _ in range(rounds if v else 0):
        tree = spark.sparkContext.broadcast(prefixes(known))
        used = (counted.where("c > 0").mapInArrow(partial(count_uses, tree=tree), USES)
                .groupBy("piece").agg(F.sum("n").alias("n")).collect())  # at most a row a piece again
        known, stop = scores(pieces, {ids[bytes(r.piece)]: r.n / UNIT for r in used}, v)
    model = Model(prefixes(known), stop, discount(once, twice), v, ends, n + ends)
    n, v = n + ends, v + (ends > 0)
    words = saved(counted.mapInArrow(partial(score_words, model=spark.sparkContext.broadcast(tuple(model))), SCORED),
                  "lm-words")

    # the count from which words are common: at most ``hot`` of them
    level = F.floor(F.log2("c") * 4).cast("int")
    levels = words.where("c > 0").groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 1 << 20, 0
    for r in sorted(levels, key=lambda r: -r.l):
        total += r.n
        if total > hot:
            break
        least = r.l
    is_hot = F.coalesce((F.col("c") > 0) & (level >= least), F.lit(False))
    common = words.where(is_hot).select("k", half(F.col("c")).alias("base"), "lp").toArrow()
    table = spark.sparkContext.broadcast((common["k"].to_pylist(), common["base"].to_numpy(), common["lp"].to_numpy(),
                                          np.ones(len(common))))

    parts = (texts.withColumn("row", F.monotonically_increasing_id())
             .mapInArrow(partial(read_texts, hot=table), PARTS))
    joined = parts.join(words.where(~is_hot), "k", "left")
    tf = F.col("tf")
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, tf).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.coalesce(tf * half(F.col("c")), F.lit(0.0))).alias("base"),
        F.sum(F.col("lattice") + F.coalesce(tf * F.col("lp"), F.lit(0.0))).alias("lattice"))
    norm = math.log10(n + 0.5 * (v + 1))
    return sums.select(
        "doc_id", (fold == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("n_known") + int(ends > 0)).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + 0.5) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("lattice") + model.end()).alias("score"))
