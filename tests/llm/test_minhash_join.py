"""Multi-index Hamming join against brute force."""

import random

import numpy as np
import pytest

from spindex.llm import minhash_join as J
from spindex.llm import minhash_sets as M


def words(text):
    return (text or "").encode().translate(M.PLAIN).split()


def shingles(text, n=4):
    w = words(text)
    return frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def by_hand(rows):
    """{row number: (doc_id, n, component, kept)} over all pairs of documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    by = {}
    for k, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(k)
    pairs = {(a, b) for m in by.values() for i, a in enumerate(m) for b in m[:i]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * len(sets[a] | sets[b]):
            up[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        ids = [x for x in (i, least.get(top(k))) if x is not None]
        least[top(k)] = min(ids, default=None)
    out = [(i, len(s), least[top(k)], i == least[top(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_small_table(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.select("doc_id", "text").collect()]
    assert found(J.groups(small_docs)) == by_hand(rows)


def test_odd_and_empty(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(J.groups(odd_docs)) == by_hand(rows)
    assert found(J.groups(no_docs)) == []


def near_copies(seed=5):
    """Chains and groups around the threshold: one text with 1 to 12 words changed, again and again."""
    rnd = random.Random(seed)
    rows = []
    for g in range(4):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((12, 60, 150)))]
        for _ in range(45):
            own = list(base)
            for _ in range(rnd.choice((0, 1, 1, 2, 3, 5, 8, 12))):
                own[rnd.randrange(len(own))] = f"x{rnd.randrange(3000)}"
            if rnd.random() < 0.2:
                base = own
            rows.append((len(rows), " ".join(own)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("tiny", [False, True])
def test_near_copies(spark, monkeypatch, tiny):
    if tiny:  # many blocks, many salts
        monkeypatch.setattr(J, "BLOCK", 5)
        monkeypatch.setattr(J, "PAIRS", 3)
    rows = near_copies()
    got = found(J.groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == by_hand(rows) and 1 < len({r[2] for r in got}) < len(rows)


def test_past_the_broadcast_bounds(spark, monkeypatch):
    from spindex.llm.common import lookup_join
    monkeypatch.setattr(J, "lookup_join", lambda *a, **k: lookup_join(*a, **{**k, "limit": 2, "hot": 3}))
    rows = near_copies(9) + [(1000 + i, "the same short text") for i in range(50)]
    assert found(J.groups(spark.createDataFrame(rows, "doc_id long, text string"))) == by_hand(rows)


def test_all_signatures_within_the_threshold_share_a_key():
    rnd = np.random.default_rng(3)
    for _ in range(2000):
        a = rnd.integers(0, 1 << 16, M.POSITIONS, dtype=np.uint16)
        b = a.copy()
        b[rnd.choice(M.POSITIONS, 25, replace=False)] ^= np.uint16(1)
        ka, kb = M.chunk_keys(np.array([a, b]))
        assert (ka == kb).any()


def test_sets_bitmaps_and_signatures():
    rnd = random.Random(1)
    texts = [" ".join(f"W{rnd.randrange(40)}\t" for _ in range(rnd.choice((0, 1, 3, 4, 9, 300)))).encode() for _ in range(60)]
    texts += ["é\x1cx  É\n\x0bz Z\x0c".encode(), b"a" * 3_000_000]
    sets = M.shingle_sets(texts, 4)
    plain = [shingles(t.decode()) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for a in range(0, len(sets), 3):
        for b in range(len(sets)):
            assert M.common(sets[a], sets[b]) == len(plain[a] & plain[b])
            if len(sets[a]) and len(sets[b]):
                n = len(sets[a]) + len(sets[b])
                ok = J.bits_allow(M.bitmap(sets[a]), len(sets[a]), [M.bitmap(sets[b])], np.array([len(sets[b])]))[0]
                assert ok or 9 * len(plain[a] ^ plain[b]) > n
    full = [s for s in sets if len(s)]
    assert (M.signatures(full[:3]) == M.signatures(full)[:3]).all()
