"""DuckDB SQL text of the same definitions, for the correctness gate.

The oracle scans with the plain RE2 patterns (no gating, no bounds, no
possessive marks), so it checks the JVM-side gating independently; it shares
the rule text with the engine, which only the hand-derived tokenizer cases
in tests/ can check.
"""

from __future__ import annotations

from .functions import analyzer as A
from .functions import rules as R


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOPLIST = "(" + ", ".join(lit(w) for w in R.STOPWORDS) + ")"


def _starts(x: str, r: R.Rule) -> str:
    return f"regexp_matches({x}, {lit('^(?:' + r.re2 + ')')})"


def _ignored(x: str) -> str:
    return f"regexp_matches({x}, {lit('^' + R.IGNORE_CLASS)})"


def norm_sql(x: str, norm: str) -> str:
    if norm == "url":
        return f"regexp_replace(lower({x}), {lit(R.URL_STRIP)}, '', 'g')"
    if norm == "url_compact":
        return f"regexp_replace(lower({x}), {lit(R.URL_STRIP_COMPACT)}, '', 'g')"
    if norm == "number":
        return f"regexp_replace({x}, {lit(R.NUMBER_STRIP)}, '', 'g')"
    if norm == "keep":
        return x
    if norm == "email_compact":
        return f"regexp_replace({x}, {lit(R.EMAIL_STRIP_COMPACT)}, '', 'g')"
    if norm == "word":
        return f"regexp_replace(lower({x}), {lit(R.WORD_STRIP)}, '', 'g')"
    raise ValueError(norm)


def token_case(x: str, analyzer: str = "full") -> str:
    """Token of a raw (group-1) lexeme: the first emitted rule matching at its start."""
    emitted = [r for r in R.RULE_SETS[analyzer] if r.emit]
    parts = [f"WHEN {_starts(x, r)} THEN {norm_sql(x, r.norm)}" for r in emitted[:-1]]
    return "CASE " + " ".join(parts) + f" ELSE {norm_sql(x, emitted[-1].norm)} END"


def kind_case(x: str, analyzer: str = "full") -> str:
    parts = [f"WHEN {_ignored(x)} THEN 'ignore'"]
    for r in R.RULE_SETS[analyzer]:
        parts.append(f"WHEN {_starts(x, r)} THEN {lit(r.kind)}")
    return "CASE " + " ".join(parts) + " ELSE 'unmatched' END"


def lexemes_sql(body: str, analyzer: str = "full", by_line: bool = True, group: int = 1) -> str:
    """Rule lexemes (group 1) or all lexemes, ignored runs included (group 0)."""
    pattern = lit(A.line_pattern(analyzer, "re2"))
    text = f"coalesce({body}, '')"
    if not by_line:
        arr = f"regexp_extract_all({text}, {pattern}, {group})"
    else:
        arr = (f"flatten(list_transform(string_split_regex({text}, {lit(R.LINE_SPLIT)}), "
               f"lambda l: regexp_extract_all(l, {pattern}, {group})))")
    if group == 1:
        arr = f"list_filter({arr}, lambda s: s IS NOT NULL AND s <> '')"
    return arr


def tokens_sql(body: str, analyzer: str = "full", by_line: bool = True) -> str:
    return f"list_transform({lexemes_sql(body, analyzer, by_line)}, lambda x: {token_case('x', analyzer)})"


def valid_sql(t: str) -> str:
    return f"(length({t}) > 1 AND {t} NOT IN {STOPLIST})"


def natural_key_sql(name: str) -> str:
    s = "s"
    digits = f"regexp_replace({s}, '^0+', '')"
    enc = (f"CASE WHEN regexp_matches({s}, '^[0-9]') THEN lpad(CAST(length({digits}) AS VARCHAR), 10, '0') || {digits} "
           f"ELSE regexp_replace(replace({s}, '~', chr(1)), '([^A-Za-z\\x01])', '~\\1', 'g') END")
    return (f"array_to_string(list_transform(regexp_extract_all(split_part(coalesce({name}, ''), '.', 1), "
            f"'[0-9]+|[^0-9]+'), lambda s: {enc}), '') || chr(2)")


# ---------------------------------------------------------------------------
# CTE builders
# ---------------------------------------------------------------------------
def docs_cte(table: str) -> str:
    if table == "pages":
        return "docs AS (SELECT page_id AS doc_id, CAST(page_id AS VARCHAR) || '.html' AS name, html AS body FROM pages)"
    if table == "documents":
        return "docs AS (SELECT doc_id, CAST(doc_id AS VARCHAR) || '.txt' AS name, text AS body FROM documents)"
    raise ValueError(table)


def tok_cte(analyzer: str = "full") -> str:
    return (f"tok AS (SELECT doc_id, toks AS tokens, CAST(len(toks) AS BIGINT) AS doc_len FROM "
            f"(SELECT doc_id, {tokens_sql('body', analyzer)} AS toks FROM docs))")


def freq_ctes(profile: str) -> list[str]:
    """terms -> freq(doc_id, doc_len, term, raw_freq) for a profile."""
    if profile == "raw":
        terms = "SELECT doc_id, doc_len, unnest(tokens) AS term FROM tok"
    else:
        terms = "SELECT doc_id, doc_len, unnest(list_filter(tokens, lambda t: " + valid_sql("t") + ")) AS term FROM tok"
    out = [f"terms AS ({terms})",
           "freq0 AS (SELECT doc_id, doc_len, term, count(*) AS raw_freq FROM terms GROUP BY doc_id, doc_len, term)"]
    if profile == "stemmed":
        from .functions.stemmer import stem_sql
        out.append("vocab AS (SELECT DISTINCT term FROM freq0)")
        out.append(f"stems AS (SELECT term, {stem_sql('term')} AS stem FROM vocab)")
        out.append("freq AS (SELECT doc_id, doc_len, stem AS term, CAST(sum(raw_freq) AS BIGINT) AS raw_freq "
                   "FROM freq0 JOIN stems USING (term) GROUP BY doc_id, doc_len, stem)")
    else:
        out.append("freq AS (SELECT * FROM freq0)")
    return out


def prune_where(mode: str | None) -> str:
    if mode is None:
        return "TRUE"
    if mode == "once":
        return "NOT (num_docs = 1 AND coll_freq = 1)"
    if mode == "tf_one":
        return "NOT (num_docs = 1 AND whole_doc = 1)"
    raise ValueError(mode)


def index_ctes(table: str, profile: str = "weighted", prune: str | None = "once", analyzer: str = "full") -> list[str]:
    """docs, tok, terms, freq, dfs, kept, n, post(term, doc_id, raw_freq, tf, weight)."""
    if profile == "raw":
        prune = None
    ctes = [docs_cte(table), tok_cte(analyzer)] + freq_ctes(profile)
    ctes.append("dfs AS (SELECT term, count(*) AS num_docs, CAST(sum(raw_freq) AS BIGINT) AS coll_freq, "
                "max(CASE WHEN raw_freq = doc_len THEN 1 ELSE 0 END) AS whole_doc FROM freq GROUP BY term)")
    ctes.append(f"kept AS (SELECT * FROM dfs WHERE {prune_where(prune)})")
    ctes.append("n AS (SELECT count(*) AS n_docs FROM docs)")
    if profile == "raw":
        ctes.append("post AS (SELECT f.term, f.doc_id, f.raw_freq, CAST(f.raw_freq AS DOUBLE) AS tf, "
                    "CAST(f.raw_freq AS DOUBLE) AS weight FROM freq f JOIN kept k ON f.term = k.term)")
    else:
        ctes.append("post AS (SELECT f.term, f.doc_id, f.raw_freq, CAST(f.raw_freq AS DOUBLE) / f.doc_len AS tf, "
                    "(CAST(f.raw_freq AS DOUBLE) / f.doc_len) * (1 + log10(CAST((SELECT n_docs FROM n) AS DOUBLE) / k.num_docs)) "
                    "AS weight FROM freq f JOIN kept k ON f.term = k.term)")
    return ctes


def queries_cte(source: str) -> str:
    """``benchmark`` or a literal query text."""
    if source == "benchmark":
        return "qs AS (SELECT item_id AS query_id, text FROM benchmark)"
    return f"qs AS (SELECT CAST(0 AS BIGINT) AS query_id, {lit(source)} AS text)"


def query_ctes(source: str, mode: str = "lenient", stemmed: bool = False, analyzer: str = "full") -> list[str]:
    """qs, qtok(query_id, pos, token, reason), qterms(query_id, term, mult)."""
    toks = tokens_sql("text", analyzer, by_line=False)
    reason = f"CASE WHEN {valid_sql('token')} THEN NULL WHEN length(token) = 1 THEN 'one_char' ELSE 'stopword' END"
    ctes = [queries_cte(source),
            f"qlist AS (SELECT query_id, {toks} AS toks FROM qs)",
            "qtok0 AS (SELECT query_id, CAST(unnest(range(len(toks))) AS BIGINT) AS pos, unnest(toks) AS token FROM qlist)",
            f"qtok AS (SELECT query_id, pos, token, {reason} AS reason FROM qtok0)"]
    where = "reason IS NULL"
    if mode == "strict":
        where += " AND query_id NOT IN (SELECT query_id FROM qtok WHERE reason IS NOT NULL)"
    term = "token"
    if stemmed:
        from .functions.stemmer import stem_sql
        term = stem_sql("token")
    ctes.append(f"qterms AS (SELECT query_id, term, count(*) AS mult FROM "
                f"(SELECT query_id, {term} AS term FROM qtok WHERE {where}) GROUP BY query_id, term)")
    return ctes


def search_ctes(k: int = R.TOP_K) -> list[str]:
    """matches, scores, top(query_id, rank, doc_id, score) over qterms and post."""
    return [
        "matches AS (SELECT q.query_id, q.term, q.mult, p.doc_id, p.weight FROM qterms q JOIN post p ON q.term = p.term)",
        "scores AS (SELECT query_id, doc_id, CAST(sum(CAST(weight * mult AS DECIMAL(38, 18))) AS DOUBLE) AS score FROM matches GROUP BY query_id, doc_id)",
        "ranked AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id "
        "ORDER BY score DESC, doc_id DESC) AS rnk FROM scores)",
        f"top AS (SELECT query_id, CAST(rnk AS BIGINT) AS rank, doc_id, score FROM ranked WHERE rnk <= {k})",
    ]


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
