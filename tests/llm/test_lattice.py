import math
import random
import re
import zlib
from collections import Counter

import pytest

from spindex.llm import lattice_lm as M


def test_forward_sums_all_segmentations():
    rng = random.Random(6)
    letters = [bytes([b]) for b in b"ab "]
    for _ in range(50):
        pieces = set(letters) | {bytes(rng.choice(b"ab ") for _ in range(rng.randrange(2, 5))) for _ in range(6)}
        score = {p: math.log(rng.uniform(0.01, 0.2)) for p in pieces}
        text = bytes(rng.choice(b"ab ") for _ in range(rng.randrange(9)))

        def every(rest):
            if not rest:
                return 1.0
            return sum(math.exp(s) * every(rest[len(p):]) for p, s in score.items() if rest.startswith(p))
        assert math.isclose(math.exp(M.marginal(text, M.prefixes(score))), every(text), rel_tol=1e-9)
    assert M.marginal(b"zz", M.prefixes({b"a": -1.0})) == -math.inf


def test_expected_uses_are_those_of_all_segmentations():
    rng = random.Random(8)
    for _ in range(50):
        pieces = {b"a", b"b", b" "} | {bytes(rng.choice(b"ab ") for _ in range(rng.randrange(2, 5))) for _ in range(6)}
        score = {p: math.log(rng.uniform(0.01, 0.2)) for p in pieces}
        text = bytes(rng.choice(b"ab ") for _ in range(rng.randrange(1, 9)))

        def every(rest):
            if not rest:
                yield []
            for p in pieces:
                if rest.startswith(p):
                    yield from ([p, *more] for more in every(rest[len(p):]))
        chances = [(cut, math.exp(sum(score[p] for p in cut))) for cut in every(text)]
        total, want, slow = sum(c for _, c in chances), Counter(), Counter()
        for cut, c in chances:
            for p in cut:
                want[p] += c / total
        M.add_uses(text, M.prefixes(score), slow)
        net = M.net(M.prefixes(score))
        counts = M.np.zeros(len(net.names), M.np.int64)
        assert M.add_uses_many([text, text[::-1], text], net, counts) == []
        back = Counter()
        M.add_uses(text[::-1], M.prefixes(score), back)
        fast = dict(zip(net.names, counts, strict=True))
        for p in pieces:
            assert slow[p] / M.UNIT == pytest.approx(want[p], abs=1e-5)
            assert (fast[p] - back[p]) / M.UNIT == pytest.approx(2 * want[p], abs=1e-4)


def test_a_round_raises_the_likelihood_and_short_numbers_are_left_to_logs():
    words_ = [b" abab", b" abba", b" baab", b" ab", b" b"] * 4
    pieces = dict(enumerate([b" ", b"a", b"b", b"ab", b"ba", b" a", b" ab", b"abb"]))
    ids = {p: i for i, p in pieces.items()}
    known, stop = M.scores(pieces, {}, len(words_))
    seen = []
    for _ in range(4):
        tree, uses = M.prefixes(known), Counter()
        seen.append(sum(M.marginal(w, tree) + stop for w in words_))
        for w in words_:
            M.add_uses(w, tree, uses)
        known, stop = M.scores(pieces, {ids[p]: n / M.UNIT for p, n in uses.items()}, len(words_))
    assert seen == sorted(seen) and seen[-1] > seen[0] + 1
    net = M.net({b"a": -23.0, b"b": -1.0})
    counts = M.np.zeros(len(net.names), M.np.int64)
    assert M.add_uses_many([b"a" * 40, b"b" * 40, b"c" * 40], net, counts) == [b"a" * 40, b"c" * 40]
    assert dict(zip(net.names, counts, strict=True)) == {b"": 0, b"a": 0, b"b": 40 * M.UNIT}


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def by_hand(rows, path):
    """Scores by the definition, with the segmentation of the tokenizer for the counts."""
    from tokenizers import Tokenizer
    model, letters = Tokenizer.from_file(path).model, M.encoder(path).letters
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows]
    counts, used, ends = Counter(), Counter(), held.count(False)
    for h, (_, t) in zip(held, rows, strict=True):
        if not h:
            counts.update(words(t))
    for w in counts:
        used.update(t.id for t in model.tokenize(M.spelt(w, letters)))
    pieces = M.vocabulary(path)
    known, stop = M.scores(pieces, used, len(counts))
    for _ in range(M.ROUNDS if counts else 0):
        uses, tree = Counter(), M.prefixes(known)
        for w in counts:
            M.add_uses(b" " + w, tree, uses)
        known, stop = M.scores(pieces, {i: uses[p] / M.UNIT for i, p in pieces.items()}, len(counts))
    tree = M.prefixes(known)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    seen = Counter(counts.values())
    less = seen[1] / (seen[1] + 2 * seen[2]) if seen[1] else 0.5

    def word(w):
        spelling = (less * len(counts) + 0.5) / (n + 1) * math.exp(M.marginal(b" " + w, tree) + stop)
        whole = max(counts[w] - less, 0) / (n + 1)
        if whole + spelling:
            return math.log10(whole + spelling)
        return (math.log((less * len(counts) + 0.5) / (n + 1)) + M.marginal(b" " + w, tree) + stop) / math.log(10)

    out = []
    for h, (i, t) in zip(held, rows, strict=True):
        own = words(t)
        cs = [counts[w] for w in own] + [ends]
        out.append((i, h, len(cs), sum(c > 0 for c in cs), n, sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in cs),
                    sum(map(word, own)) + math.log10((ends + 0.5) / (n + 1))))
    return out


@pytest.mark.parametrize("hot", [M.HOT, 40])
def test_scores_by_hand(odd_docs, small_docs, vocabulary, hot):
    for docs in (odd_docs, small_docs):
        key = lambda r: (r[0] is None, r[0] or 0, r[2])
        got = sorted((tuple(r) for r in M.score(docs, vocabulary, hot).collect()), key=key)
        want = sorted(by_hand([(r.doc_id, r.text) for r in docs.collect()], vocabulary), key=key)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        for a, b in zip(got, want, strict=True):
            assert a[5] == pytest.approx(b[5], rel=1e-9)
            assert a[6] == pytest.approx(b[6], rel=1e-7)  # short words' uses are rounded in another place


@pytest.mark.parametrize("hot", [M.HOT, 3])
def test_a_long_word_that_stands_everywhere(spark, vocabulary, hot):
    """A separator of over 48 bytes is a common word like any other; longer ones too."""
    rows = [(i, f"w{i % 7} {'-' * 60} w{i % 3} {'=' * 5000}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in M.score(docs, vocabulary, hot).collect())
    for a, b in zip(got, sorted(by_hand(rows, vocabulary)), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-7)


def test_no_texts(no_docs, vocabulary):
    assert M.score(no_docs, vocabulary).collect() == []


def test_scores_are_a_distribution(vocabulary):
    known, stop = M.scores(M.vocabulary(vocabulary), {5: 10, 300: 4}, 3)
    assert math.isclose(sum(math.exp(s) for p, s in known.items() if p[0] == 32), 1.0, rel_tol=1e-9)
    assert math.isclose(sum(math.exp(s) for p, s in known.items() if p[0] != 32) + math.exp(stop), 1.0, rel_tol=1e-9)


def test_words_and_the_end_sum_to_one():
    """All words over one letter, with pieces of one and two letters: their probabilities and the end's."""
    pieces = {0: b" ", 1: b"a", 2: b"aa", 3: b" a"}
    known, stop = M.scores(pieces, {0: 2, 1: 3, 2: 1, 3: 4}, 4)
    counts = {b"a": 5, b"aaa": 1, b"aaaa": 2}
    model = M.Model(M.prefixes(known), stop, M.discount(1, 1), len(counts), 3, sum(counts.values()) + 3)
    total = 10 ** model.end() + sum(10 ** model.word(b"a" * k, counts.get(b"a" * k, 0)) for k in range(400))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_training_words_outweigh_spelling(spark, small_docs, vocabulary):
    """Held-out texts score far better than by spelling alone, and near the base, which spells nothing."""
    rows = [r for r in M.score(small_docs, vocabulary).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) - 1.5 * tokens


def test_held_out_texts_beat_shuffled_letters(spark, small_docs, vocabulary):
    """The model prefers real held-out texts to the same letters in random order."""
    rng = random.Random(7)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    held = [(i, t) for i, t in rows if M.is_held_out(i) and len(words(t)) > 5][:20]
    assert held
    noise, taken = [], {i for i, _ in rows}
    extra = (i for i in range(10_000, 99_999) if M.is_held_out(i) and i not in taken)
    for i, t in held:
        letters = [c for c in t if not c.isspace()]
        rng.shuffle(letters)
        it = iter(letters)
        noise.append((next(extra), "".join(c if c.isspace() else next(it) for c in t), i))
    frame = spark.createDataFrame(rows + [(j, t) for j, t, _ in noise], "doc_id long, text string")
    score = {r.doc_id: r.score for r in M.score(frame, vocabulary).collect()}
    assert all(score[i] > score[j] for j, _, i in noise)
