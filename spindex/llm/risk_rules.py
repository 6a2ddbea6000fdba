"""Quality rules whose cutoffs come with a proven limit on false rejection.

Rules turn a document's counts into one number each (share of symbols, of
repeated lines, ...) and reject above a cutoff. Cutoffs are chosen from fixed
grids, for each stratum (language) by itself, by the labelled documents of good
quality that pass the base rules. A stratum goes through one fixed sequence of
nested rule sets, loosest first (``STEPS``). Each set is tested as a whole: it is
allowed if, were its true rate of false rejection ``alpha`` or more, so few
rejected good documents as were seen would have a probability of at most
``delta`` / strata (the exact binomial tail, i.e. a Clopper-Pearson bound, with a
Bonferroni correction for the strata). The walk stops at the first set that
fails; going on only after a success needs no correction for the number of sets.
So with probability 1 - ``delta`` no stratum loses more than ``alpha`` of its
good documents *that pass the base rules* to all cutoffs together; what the base
rules reject isn't bounded. With 4 strata about 220 good labels a stratum are
the least that allow a cutoff; with fewer only the base rules hold there.

``cutoffs`` is another way, on request: every cutoff of every rule is tested by
itself at ``alpha`` / rules and ``delta`` / (strata * rules * cutoffs). It needs
about 2,000 good labels a stratum.

All of it is DataFrame operations. The counts are taken inside each row (the
text is never exploded or shuffled); what is shuffled is one small row a
labelled document and one row a stratum.

Null text has no words (it fails the base rules); a null language is the
stratum of the empty language; labels that repeat a document count once, with
the lowest quality; null or absent labels are not used; repeated rows are
judged one by one; a null id has no label. Columns of the documents are kept by
``kept_documents``, whatever their names. An empty table gives no rows; without
labels only the base rules hold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, SPACE_RE, leave_out, saved, text_of, without_space

ALPHA, DELTA = 0.02, 0.05
LEAST_WORDS, MOST_REPEATED = 50, 50
SYMBOLS = r"[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: A rule's number, in terms of the counts, and its grid of cutoffs, strictest first.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("n_symbols / n_words", (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4)),
    "dup_lines": ("n_dup_lines / n_lines", (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)),
    "repeat_words": ("n_repeat_words / n_words", (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    "long_words": ("word_chars / n_words", (6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0)),
    "short_words": ("- word_chars / n_words", (-5.0, -4.5, -4.0, -3.5, -3.0, -2.5, -2.0)),
}
#: The walk: in each step one rule gets the next stricter cutoff of its grid, in the order of RULES.
STEPS: list[tuple[str, float]] = [(r, c) for level in zip(*(reversed(g) for _, g in RULES.values()), strict=True)
                                  for r, c in zip(RULES, level, strict=True)]


def with_counts(docs: DataFrame) -> DataFrame:
    """The rows with the counts as long columns.

    Repeated words: the text's 3-word windows are hashed (64 bits, inside one
    text). Only where some window comes twice are they sorted, those equal to a
    neighbour taken, and the words they cover counted once each."""
    p = lambda name: f"_llm_{name}"
    one = docs.withColumn(p("text"), text_of())
    one = one.withColumn(p("words"), F.array_remove(F.split(F.col(p("text")), SPACE_RE + "+"), ""))
    words, n = F.col(p("words")), F.size(p("words"))
    has_word = F.filter(F.split(F.col(p("text")), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    one = one.withColumns({
        p("lines"): has_word,
        p("windows"): F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
            F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))),
        p("n_words"): n.cast("long"),
        p("word_chars"): F.length(without_space(F.col(p("text")))).cast("long"),
        p("n_symbols"): (F.size(F.split(F.col(p("text")), SYMBOLS)) - 1).cast("long"),
    })
    windows = F.col(p("windows"))
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    one = one.withColumn(p("pairs"), F.when(F.size(F.array_distinct(windows)) < F.size(windows), pairs))
    pairs = F.col(p("pairs"))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    twice = F.filter(pairs, lambda x, i: same(x, F.get(pairs, i - 1)) | same(x, F.get(pairs, i + 1)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])
    done = one.withColumns({
        p("n_lines"): F.size(p("lines")).cast("long"),
        p("n_dup_lines"): (F.size(p("lines")) - F.size(F.array_distinct(p("lines")))).cast("long"),
        p("n_repeat_words"): F.coalesce(covered, F.lit(0)).cast("long"),
    })
    return done.select(*docs.columns, *(F.col(p(c)).alias(c) for c in COUNTS))


def base_failed() -> Column:
    n, r = F.col("n_words"), F.col("n_repeat_words")
    return (n < LEAST_WORDS) | (100 * r > MOST_REPEATED * n)


def rule_number(rule: str) -> Column:
    text = RULES[rule][0]
    for c in COUNTS:
        text = text.replace(c, f"cast({c} as double)")
    return F.expr(text)


def stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), exact up to rounding, for k < n * p;
    1 beyond, where no cutoff is allowed. With S(j) = 1 + S(j - 1) * j (1 - p) /
    ((n - j + 1) p) the tail is S(k) times the probability of k."""
    step = lambda a, j: F.struct(
        (a["c"] + F.log((n - j + 1) / j)).alias("c"),
        (F.lit(1.0) + a["s"] * j * F.lit((1 - p) / p) / (n - j + 1)).alias("s"))
    zero = F.struct(F.lit(0.0).alias("c"), F.lit(1.0).alias("s"))
    log_p, log_q = F.log(F.lit(p)), F.log(F.lit(1 - p))
    numbers = F.when(k > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
                                        lambda j: j.cast("double"))).otherwise(F.array().cast("array<double>"))
    found = F.aggregate(numbers, zero, step, lambda a: F.exp(a["c"] + k * log_p + (n - k) * log_q) * a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(found)


def labelled_good(counted: DataFrame, labels: DataFrame) -> DataFrame:
    marks = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_llm_id"))
             .agg(F.min("quality").alias("_llm_quality")))
    return (counted.where(~base_failed()).join(marks, F.col("doc_id") == F.col("_llm_id"))
            .where("_llm_quality = 1"))


def cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one column a rule): the strictest allowed cutoffs, each tested
    by itself, null where there is none. ``counted`` has doc_id, the counts and ``stratum``."""
    good = labelled_good(counted, labels)
    lost = [F.sum((rule_number(r) > c).cast("long")).alias(f"{r}_{i}")
            for r, (_, grid) in RULES.items() for i, c in enumerate(grid)]
    seen = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *lost)
    every = Window.partitionBy(F.lit(1))  # one row a stratum
    tests = F.count(F.lit(1)).over(every) * sum(len(g) for _, g in RULES.values())
    seen = seen.withColumn("level", F.lit(delta) / tests)
    share = alpha / len(RULES)

    def chosen(rule: str) -> Column:
        ok = (F.when(tail(F.col("n").cast("double"), F.col(f"{rule}_{i}"), share) <= F.col("level"), F.lit(c))
              for i, c in enumerate(RULES[rule][1]))
        return F.coalesce(*ok).alias(rule)

    return seen.select("stratum", *map(chosen, RULES))


def walked_cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, one column a rule): the cutoffs of the last set of STEPS that was allowed, null where there is none."""
    # the step whose rule set is the first to reject the document
    first = F.least(*(F.when(rule_number(r) > c, F.lit(s)).otherwise(F.lit(len(STEPS)))
                      for s, (r, c) in enumerate(STEPS)))
    good = labelled_good(counted, labels).select("stratum", first.alias("first"))
    seen = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *(
        F.sum((F.col("first") <= s).cast("long")).alias(f"lost_{s}") for s in range(len(STEPS))))
    every = Window.partitionBy(F.lit(1))  # one row a stratum
    seen = seen.withColumn("level", F.lit(delta) / F.count(F.lit(1)).over(every))
    failed = F.array(*(tail(F.col("n").cast("double"), F.col(f"lost_{s}"), alpha) > F.col("level")
                       for s in range(len(STEPS))))
    seen = seen.withColumn("stop", F.array_position(failed, True))  # from 1, 0: none failed
    seen = seen.withColumn("done", F.when(F.col("stop") == 0, F.lit(len(STEPS))).otherwise(F.col("stop") - 1))

    def chosen(rule: str) -> Column:
        own = reversed([(s, c) for s, (r, c) in enumerate(STEPS) if r == rule])
        return F.coalesce(*(F.when(F.col("done") > s, F.lit(c)) for s, c in own)).alias(rule)

    return seen.select("stratum", *map(chosen, RULES))


def judged(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and ``kept``. ``limits`` has one row a stratum and
    is broadcast after a check of its rows. ``counted`` should be saved: a
    filter on the verdict would else be pushed into the counting and repeat it."""
    limits = saved(limits, "quality-cutoffs")
    few = limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    cuts = limits.select("stratum", *(F.col(r).alias(f"cut_{r}") for r in RULES))
    over = F.lit(False)
    for r in RULES:
        over |= F.coalesce(rule_number(r) > F.col(f"cut_{r}"), F.lit(False))
    return (counted.join(F.broadcast(cuts) if few else cuts, "stratum", "left")
            .withColumns({"base_failed": base_failed(), "kept": ~base_failed() & ~over}))


def mark(docs: DataFrame) -> Column:
    """Tells rows with one id apart: the verdict depends on text and stratum."""
    return F.xxhash64(text_of(), stratum(docs))


def verdicts(docs: DataFrame, labels: DataFrame,
             limits: Callable[[DataFrame, DataFrame], DataFrame] = walked_cutoffs) -> DataFrame:
    """(doc_id, mark, stratum, counts, base_failed, kept). The counts are taken once and saved."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), mark(docs).alias("mark"),
                       stratum(docs).alias("stratum"))
    counted = saved(with_counts(cols).drop("text"), "quality-counts")
    return judged(counted, limits(counted, labels))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return leave_out(docs, verdicts(docs, labels).where("not kept"), mark(docs))


def sql(alpha: float = ALPHA, delta: float = DELTA) -> str:
    """The same in DuckDB SQL; the binomial tail is summed by lgamma."""

    def number(text: str) -> str:
        for c in COUNTS:
            text = text.replace(c, f"{c}::DOUBLE")
        return text

    first = ", ".join(f"CASE WHEN {number(RULES[r][0])} > {c} THEN {s} ELSE {len(STEPS)} END" for s, (r, c) in enumerate(STEPS))
    steps = ", ".join(f"({s}, '{r}', {c}::DOUBLE)" for s, (r, c) in enumerate(STEPS))
    picked = ", ".join(f"arg_max(cut, s) FILTER (WHERE rule = '{r}' AND s < done) AS {r}" for r in RULES)
    over = " OR ".join(f"coalesce({number(x)} > {r}, false)" for r, (x, _) in RULES.items())
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
      FROM (SELECT rid, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
v AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM g) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM v) GROUP BY rid),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
s AS (SELECT w.rid, doc_id, lang, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN cov USING (rid) LEFT JOIN ln USING (rid)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM s),
good AS (SELECT lang, least({first}) AS first FROM b
         JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l
         USING (doc_id) WHERE q = 1 AND NOT base_failed),
steps AS (SELECT * FROM (VALUES {steps}) v(s, rule, cut)),
tests AS (SELECT lang, s, count(*) AS n, count(*) FILTER (WHERE first <= s) AS k FROM good, steps GROUP BY lang, s),
terms AS (SELECT lang, s, n, unnest(generate_series(0, k)) AS x FROM tests WHERE k < n * {alpha}),
ok AS (SELECT lang, s FROM terms GROUP BY lang, s HAVING
         sum(exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln({alpha}) + (n - x) * ln(1 - {alpha})))
         <= {delta} / (SELECT count(DISTINCT lang) FROM good)),
walk AS (SELECT tests.lang, coalesce(min(tests.s) FILTER (WHERE ok.s IS NULL), {len(STEPS)}) AS done
         FROM tests LEFT JOIN ok ON tests.lang = ok.lang AND tests.s = ok.s GROUP BY tests.lang),
cuts AS (SELECT lang, {picked} FROM walk, steps GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({over}) AS kept
FROM b LEFT JOIN cuts USING (lang)
"""
