import hashlib
import random
import re
from collections import Counter, defaultdict

import __spark_entry__
import corpus_pipeline as C
from spindex.llm import binary_packing, catalog, line_chunks, risk_rules, simhash_bk, source_schedule

from .test_dedup import groups_by_hand, lines_by_hand
from .test_rules_and_mixing import counts_by_hand, targets_by_hand, walk_by_hand
from .test_tokens import crc, plain


def test_each_stage_does_its_operators_work(spark, small_docs, vocabulary):
    sf = "/root/testdata/sf0.001"
    docs = small_docs
    names = [n for n, _ in C.STAGES]
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf).cache()
        if name == "quality":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            want = {r.doc_id for r in risk_rules.verdicts(docs, labels).collect() if r.kept}
            assert {r.doc_id for r in out.collect()} == want and 0 < len(want) < docs.count()
        elif name == "line_dedup":
            assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter(
                (r.doc_id, r.text) for r in line_chunks.without_repeats(docs).collect())
        elif name == "near_dedup":
            want = {r.component_id for r in simhash_bk.groups(docs).collect()}
            assert {r.doc_id for r in out.collect()} == want and out.count() == len(want)
        elif name == "mixing":
            taken = {r.doc_id: r.taken for r in source_schedule.taken(docs).collect()}
            assert {r.doc_id for r in out.collect()} == {i for i, n in taken.items() if n}
        else:
            want = binary_packing.digests(binary_packing.pack(docs, vocabulary))
            assert Counter((r.doc_id, r.start, r.ids_crc32) for r in out.collect()) == Counter(
                (r.doc_id, r.start, r.ids_crc32) for r in want.collect())
        if name != "packing":
            assert out.columns == small_docs.columns
        docs = out


def test_run_on_odd_tables(spark, odd_docs, no_docs, tmp_path):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        sf = str(tmp_path / name)
        docs.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        out = C.run(spark, sf)
        assert {"doc_id", "sequence_id", "length"} <= set(out.columns)
        out.collect()


def test_registered():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in queries) == 1
    assert "pipeline" in queries and set(sql) <= set(queries) and set(catalog.SQL) <= set(sql)


def made_corpus():
    """(doc_id, text, lang, source) and labels: enough good ones in one language, too few in the other."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    passages = [[" ".join(word() for _ in range(9)) for _ in range(8)] for _ in range(5)]
    docs, labels = [], []
    for i in range(560):
        bad, lines = i % 5 == 0, [" ".join(word() for _ in range(9)) for _ in range(rng.randrange(4, 11))]
        if bad:
            lines = [x.replace(" ", " # ") for x in lines]
        if i % 4 == 1:
            lines[2:2] = rng.choice(passages)
        if i % 7 == 3:
            lines = [" ".join(lines)]
        if i % 21 == 10 and i > 40 and i % 5 in (1, 2, 4):  # a good text again, spaced otherwise
            lines = [docs[i - 28][1].replace(" ", "  ")]
        docs.append((i, "\n".join(lines), "en" if i % 6 else "fr", rng.choice(["a", "b", "b", "b", None])))
        if i % 8:
            labels.append((i, int(not bad)))
    return docs, labels


def quality_by_hand(docs, labels):
    rows = [dict(zip(risk_rules.COUNTS, counts_by_hand(t), strict=True)) | {"doc_id": i, "stratum": g} for i, t, g, _ in docs]
    cuts, kept = walk_by_hand(rows, dict(labels)), set()
    assert any(c is not None for c in cuts["en"].values()) and not any(c is not None for c in cuts["fr"].values())
    for r in rows:
        n = r["n_words"]
        if n < 50 or 2 * r["n_repeat_words"] > n:
            continue
        own = {"symbols": r["n_symbols"] / n, "dup_lines": r["n_dup_lines"] / r["n_lines"],
               "repeat_words": r["n_repeat_words"] / n, "long_words": r["word_chars"] / n, "short_words": -r["word_chars"] / n}
        if not any(c is not None and own[k] > c for k, c in cuts[r["stratum"]].items()):
            kept.add(r["doc_id"])
    return [d for d in docs if d[0] in kept]


def mixed_by_hand(docs, block=1024, least=256, most=3):
    """[(doc_id, text)] as often as the slots take them, word by word."""
    words = {i: re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t) for i, t, _, _ in docs}
    names = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    streams = [[(i, k) for i in sorted((d[0] for d in docs if d[3] == s), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
                for k in range(len(words[i]))] for s in names]
    sizes = [len(x) for x in streams]
    targets = targets_by_hand(sizes, [k % 3 + 1 for k in range(len(names))])
    blocks = [min(n, max(-(-n // block), least)) for n in sizes]
    need = [t * b / n for t, b, n in zip(targets, blocks, sizes, strict=True)]
    cut = []
    for stream, n, b in zip(streams, sizes, blocks, strict=True):
        ends = [k * (n // b) + min(k, n % b) for k in range(b + 1)]
        cut.append([stream[x:y] for x, y in zip(ends, ends[1:], strict=False)])
    turn, taken = Counter(), defaultdict(set)
    for t in range(round(sum(need))):
        point = int(f"{t:053b}"[::-1], 2) / 2**53 * sum(need)
        s = next((k for k in range(len(need)) if point < sum(need[:k + 1])), len(need) - 1)
        epoch, b = divmod(turn[s], blocks[s])
        turn[s] += 1
        if epoch < most:
            for i, k in cut[s][b]:
                taken[i, epoch].add(k)
    texts = {d[0]: d[1] for d in docs}
    return [(i, texts[i] if len(ks) == len(words[i]) else "".join(words[i][min(ks):max(ks) + 1])) for (i, _), ks in taken.items()]


def test_run_by_hand(spark, vocabulary, tmp_path):
    docs, labels = made_corpus()
    frame = spark.createDataFrame([(i, t, g, s, len(t)) for i, t, g, s in docs],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    left = quality_by_hand(docs, labels)
    shorter = {i: t for i, t in lines_by_hand([d[:2] for d in left])}
    lined = [(i, shorter[i], g, s) for i, _, g, s in left]
    first = {i for i, _, c in groups_by_hand([d[:2] for d in lined]) if i == c}
    near = [d for d in lined if d[0] in first]
    assert len(docs) > len(left) > len(near) and [d[1] for d in lined] != [d[1] for d in left]  # every stage has work
    mix = mixed_by_hand(near)
    assert max(Counter(i for i, _ in mix).values()) > 1
    want = Counter()
    for i, t in mix:
        ids, at = plain(vocabulary, t) + [0], 0
        for length in [1024] * (len(ids) // 1024) + [1 << b for b in range(9, -1, -1) if len(ids) % 1024 >> b & 1]:
            want[i, at, length, crc(ids[at:at + length]), len(ids)] += 1
            at += length
    got = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in C.run(spark, str(tmp_path)).collect())
    assert got == want
