"""The filter audit against plain Python that runs every order over the rows."""

import random
from collections import Counter
from itertools import permutations

import pytest

from spindex.llm import filter_audit as A


def by_hand(rows, labels):
    """rows (doc_id, source, text); labels (doc_id, quality, toxic). Every order is run, document by document."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least, docs = {}, []
    for i, _, text in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, source, text in rows:
        text = text or ""
        words = text.encode().split()
        docs.append((source or "", i, {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in text for c in "#$%&*|"),
            "E": i is not None and i > least[text]}))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            own = list(left)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[2][f]]
                there = {id(d) for d in left}
                left = [d for d in left if not d[2][f]]
                shapley[part, f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(d[2][f] and id(d) not in there for d in own),
                    sum(d[2][f] and sum(d[2].values()) == 1 for d in own), sum(d[1] in good for d in gone),
                    sum(d[1] in toxic for d in gone)]
    return sorted((p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items())


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def found(spark, docs, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in A.audit(docs, marks).select(*COLS).collect())


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]


@pytest.mark.parametrize("tiny", [False, True])
def test_small_table(spark, small_docs, monkeypatch, tiny):
    if tiny:  # long prefixes, a trie a few rows
        monkeypatch.setattr(A, "CELL_BYTES", 3000)
        monkeypatch.setattr(A, "HELD_BYTES", 3000)
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
              .select("doc_id", "quality", "toxic").collect()]
    again = small_docs.unionByName(small_docs.selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars"))
    assert found(spark, again, labels) == by_hand(rows_of(again), labels)


def test_odd_and_empty(spark, odd_docs, no_docs):
    labels = [(0, 1, 0), (0, 0, 1), (2, 1, 1), (None, 1, 1), (13, None, 1), (99, 1, 1)]
    assert found(spark, odd_docs, labels) == by_hand(rows_of(odd_docs), [x for x in labels if x[0] is not None])
    assert found(spark, odd_docs, []) == by_hand(rows_of(odd_docs), [])
    assert found(spark, no_docs, labels) == []


def test_heavy_prefixes_follow_the_texts(spark, monkeypatch):
    monkeypatch.setattr(A, "CELL_BYTES", 20_000)
    rows = [(i, "same start " * 40 + str(i)) for i in range(60)] + [(100 + i, f"{i} other") for i in range(10)]
    heavy = A.heavy_prefixes(spark.createDataFrame(rows, "doc_id long, text string"))
    text = rows[0][1].encode()
    assert {k for k, _ in heavy} == {0, 1, 2, 3}  # 4, 16, 64, 256 bytes; at 1024 it is whole texts
    assert len({A.cell_of(t.encode(), heavy) for _, t in rows}) == 70 and A.cell_of(text, frozenset()) != A.cell_of(text, heavy)
    copies = spark.createDataFrame([(i, "x" * 3000) for i in range(60)], "doc_id long, text string")
    assert {k for k, _ in A.heavy_prefixes(copies)} == {0, 1, 2, 3, 4}


def test_trie_is_a_dictionary_of_least_ids():
    rnd = random.Random(2)
    trie, least, gone = A.Trie(), {}, Counter()
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.choice((0, 1, 3, 8, 200)))).encode() for _ in range(300)]
    texts += [t + b"tail" for t in texts[:100]] + [b"long" * 50_000, b"long" * 50_000 + b"er"]
    rows = [(rnd.randrange(50), t) for t in texts * 3]
    for i, t in rows:
        out = trie.add(t, i, ("p", 0), 1)
        if out:
            gone[out[0]] += sum(out[1].values())
        least[t] = min(i, least.get(t, i))
    assert {t: i for t, i, _ in trie.texts()} == least
    assert sum(gone.values()) == sum(i > least[t] for i, t in rows)
    assert sum(sum(r.values()) for _, _, r in trie.texts()) == sum(i == least[t] for i, t in rows)
