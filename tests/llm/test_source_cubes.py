"""Source divergences by cubes against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from spindex.llm import source_cubes as C

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def by_hand(rows, ranks=C.RANKS):
    """Rows of (lang, source, part, item, value, rank) from (lang, source, text), with Python's own integers."""
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        own = TERM.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text))
        counts[lang, source].update(own)
        df[lang].update(set(own))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= C.LEAST_DOCS)
        share = {}
        for s in sources:
            total = sum(counts[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10 ** 9 * (counts[lang, s][t] + 1) // (total + len(kept)) for t in kept}
        every = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10 ** 9 * (every[t] + 1) // (sum(every.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(share[s][t], share[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(share[s][t], q[t]), t) for t in kept if counts[lang, s][t] and share[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, k) for k, (v, o) in enumerate(found, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def texts(df):
    return [tuple(r) for r in df.select("lang", "source", "text").collect()]


def found(df):
    return sorted(tuple(r) for r in C.audit(df).collect())


@pytest.mark.parametrize("tiny", [False, True])
def test_small_table(spark, small_docs, monkeypatch, tiny):
    if tiny:  # many blocks on every axis
        monkeypatch.setattr(C, "GROUPS", 3)
        monkeypatch.setattr(C, "TERMS", 100)
        monkeypatch.setattr(C, "HELD", 50)
    assert found(small_docs) == by_hand(texts(small_docs))


def test_odd_and_empty(spark, odd_docs, no_docs, monkeypatch):
    assert found(odd_docs) == by_hand(texts(odd_docs))
    assert found(no_docs) == []
    monkeypatch.setattr(C, "LEAST_DOCS", 1)
    assert found(odd_docs) == by_hand(texts(odd_docs))


def test_shares_are_exact():
    import numpy as np
    for count, total in ((0, 1), (0, 3), (10 ** 12, 10 ** 12 + 7), (999_999_999_999, 8 * 10 ** 15), (5, 7 * 10 ** 15)):
        assert int(C.share(np.array([count]), np.array([total]))[0]) == 1 + 10 ** 9 * (count + 1) // total


def test_hot_source_goes_by_salted_lookup(spark, monkeypatch):
    from spindex.llm import common
    rows = [("en", "hot" if k % 3 else f"s{k % 5}", f"common word w{k % 11} x{k % 7}") for k in range(200)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(C, "lookup_join", lambda *a, **k: common.lookup_join(*a, **k, limit=1, hot=5))
    assert found(df) == by_hand(rows)
