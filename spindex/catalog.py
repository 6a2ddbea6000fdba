"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle. Every query reads the driver's tables (``pages``,
``documents``, ``benchmark``) whole.

Doubles that pass through ``log10`` are rounded to 6 decimals in the
registered outputs so that the two engines' last-bit differences cannot
flip a comparison; the library itself keeps full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions import analyzer as A
from .functions import rules as R
from .operators import query as Q
from .operators import tokens as T
from .operators import weighting as Wt
from .plans import search as S
from .plans.build import build_index, frequencies
from .sources import collection as C
from .functions.text import natural_key

# Fixed query texts of the single-query keys.
QUERY_WEIGHTED = "the edon tion"
QUERY_STEMMED = "edon tions reti"
# Documents that the key of the collection's limit keeps (its tables are larger).
LIMIT = 40

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _pages(spark, sf):
    return C.pages_collection(spark, sf)


def _documents(spark, sf):
    return C.documents_collection(spark, sf)


def _benchmark(spark, sf):
    return C.read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _r6(c):
    return F.round(c, 6)


def _rounded(results):
    return results.withColumn("score", _r6(F.col("score")))


# ---------------------------------------------------------------------------
# Q7: ranked search, weighted profile, one literal query on pages
# ---------------------------------------------------------------------------
@register("search_weighted", O.with_(
    O.index_ctes("pages", "weighted", None) + O.query_ctes(QUERY_WEIGHTED) + O.search_ctes(),
    "SELECT t.query_id, t.rank, t.doc_id, d.name, round(t.score, 6) AS score FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_search_weighted(spark, sf):
    idx = build_index(_pages(spark, sf), "weighted", prune=None)
    return _rounded(S.search(idx, QUERY_WEIGHTED))


# ---------------------------------------------------------------------------
# SQL fragments shared by several oracles
# ---------------------------------------------------------------------------
def _sql_pages_tok(analyzer: str = "full") -> list[str]:
    return [O.docs_cte("pages"), O.tok_cte(analyzer)]


_EMITTED_SQL = ", ".join(O.lit(r.kind) for r in R.FULL_RULES if r.emit)


def _sql_kinded(table: str) -> list[str]:
    lex = O.lexemes_sql("body", group=0)
    return [O.docs_cte(table),
            f"lx AS (SELECT doc_id, unnest({lex}) AS x FROM docs)",
            f"kx0 AS (SELECT doc_id, {O.kind_case('x')} AS kind, x AS lexeme FROM lx)",
            f"kx AS (SELECT doc_id, kind, lexeme, CASE WHEN kind IN ({_EMITTED_SQL}) THEN {O.token_case('lexeme')} END "
            "AS token FROM kx0)"]


def _sql_names(table_cte: str, name_col: str, tiebreak: str | None = None) -> str:
    order = f"nk, {name_col}" + (f", {tiebreak}" if tiebreak else "")
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS doc_id FROM "
            f"(SELECT *, {O.natural_key_sql(name_col)} AS nk FROM {table_cte})")


_START = "CAST(coalesce(sum(num_docs) OVER (ORDER BY term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)"
_END = "CAST(sum(num_docs) OVER (ORDER BY term ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)"


def _kinded(collection: DataFrame, analyzer: str = "full") -> DataFrame:
    emitted = [r.kind for r in R.RULE_SETS[analyzer] if r.emit]
    rows = T.kinded_rows(collection, analyzer)
    return rows.withColumn("token", F.when(F.col("kind").isin(*emitted), A.token_of(F.col("lexeme"), analyzer)))


def _weighted_pages(spark, sf, prune="once", profile="weighted"):
    return build_index(_pages(spark, sf), profile, prune=prune)


def _shared(spark, name):
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid

    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _docs_index(spark, sf, profile="weighted"):
    return build_index(_documents(spark, sf), profile, prune="once")


# ---------------------------------------------------------------------------
# collection
# ---------------------------------------------------------------------------
@register("scan_documents", O.with_([O.docs_cte("pages")], "SELECT doc_id, name, body FROM docs"))
def q_scan_documents(spark, sf):
    return _pages(spark, sf).select("doc_id", "name", "body")


@register("scan_directory", "SELECT CAST(page_id AS VARCHAR) AS name, coalesce(html, '') || chr(10) AS body FROM pages")
def q_scan_directory(spark, sf):
    """The pages as a directory of text files (a file a page, closed by a line end), scanned."""
    path = _shared(spark, "pages")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    pages = C.read_table(spark, sf, "pages")
    C.write_files(pages.select(F.concat(F.lit("page_id="), page, F.lit(".txt")).alias("name"), F.col("html").alias("body")), path)
    found = C.scan_documents(spark, path, "*.txt")
    return found.select(F.regexp_extract("name", r"^page_id=(.*)\.txt$", 1).alias("name"), "body")


@register("limit_collection", O.with_(
    ["named AS (SELECT CAST(page_id AS VARCHAR) || '.html' AS name FROM pages)",
     f"ids AS ({_sql_names('named', 'name')})"],
    f"SELECT doc_id, name FROM ids WHERE doc_id < {LIMIT}"))
def q_limit_collection(spark, sf):
    pages = C.read_table(spark, sf, "pages")
    return C.limited(pages, "html", F.concat(F.col("page_id").cast("string"), F.lit(".html")), LIMIT).select("doc_id", "name")


@register("natural_sort", O.with_(
    ["src AS (SELECT DISTINCT source FROM documents)", f"ids AS ({_sql_names('src', 'source')})"],
    "SELECT source, nk AS natural_key, doc_id AS position FROM ids"))
def q_natural_sort(spark, sf):
    src = C.read_table(spark, sf, "documents").select("source").distinct()
    out = C.assign_doc_ids(src.withColumn("natural_key", natural_key(F.col("source"))), "source")
    return out.select("source", "natural_key", F.col("doc_id").alias("position"))


@register("assign_doc_ids", O.with_(
    ["src AS (SELECT source, doc_id AS orig_doc_id FROM documents)",
     f"ids AS ({_sql_names('src', 'source', 'orig_doc_id')})"],
    "SELECT source, orig_doc_id, doc_id FROM ids"))
def q_assign_doc_ids(spark, sf):
    src = C.read_table(spark, sf, "documents").select("source", F.col("doc_id").alias("orig_doc_id"))
    return C.assign_doc_ids(src, "source", ["orig_doc_id"]).select("source", "orig_doc_id", "doc_id")


@register("mapping_table", O.with_(
    ["named AS (SELECT CAST(page_id AS VARCHAR) || '.html' AS name FROM pages)",
     f"ids AS ({_sql_names('named', 'name')})"],
    "SELECT doc_id, name FROM ids"))
def q_mapping_table(spark, sf):
    pages = C.read_table(spark, sf, "pages")
    names = pages.select(F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("name"))
    return C.assign_doc_ids(names).select("doc_id", "name")


# ---------------------------------------------------------------------------
# Dictionary, postings, exports
# ---------------------------------------------------------------------------
@register("dictionary_table", O.with_(O.index_ctes("pages", "weighted", "once"),
                                      f"SELECT term, num_docs, {_START} AS start FROM kept"))
def q_dictionary_table(spark, sf):
    return _weighted_pages(spark, sf).dictionary("start")


@register("dictionary_end_offset", O.with_(O.index_ctes("pages", "raw"),
                                           f"SELECT term, num_docs, {_END} AS \"end\" FROM kept"))
def q_dictionary_end_offset(spark, sf):
    return build_index(_pages(spark, sf), "raw").dictionary("end")


@register("raw_postings", O.with_(O.index_ctes("pages", "raw"), "SELECT term, doc_id, raw_freq FROM post"))
def q_raw_postings(spark, sf):
    return build_index(_pages(spark, sf), "raw").postings.select("term", "doc_id", "raw_freq")


@register("weighted_postings", O.with_(O.index_ctes("pages", "weighted", None),
                                       "SELECT term, doc_id, raw_freq, tf, round(weight, 6) AS weight FROM post"))
def q_weighted_postings(spark, sf):
    p = _weighted_pages(spark, sf, None).postings
    return p.select("term", "doc_id", "raw_freq", "tf", _r6(F.col("weight")).alias("weight"))


@register("stopword_hits", O.with_(
    _sql_pages_tok() + ["tt AS (SELECT unnest(tokens) AS term FROM tok)"],
    f"SELECT term, count(*) AS hits FROM tt WHERE term IN {O.STOPLIST} GROUP BY term"))
def q_stopword_hits(spark, sf):
    tt = T.token_rows(_pages(spark, sf))
    return tt.where(F.col("term").isin(*R.STOPWORDS)).groupBy("term").agg(F.count(F.lit(1)).alias("hits"))


def _fixed_sql(rows: str, keys: str, fields: dict[str, tuple[str, int]], line: str) -> str:
    """Lines of ``rows`` (a relation) with every field as wide, in bytes, as its longest value."""
    wide = ", ".join(f"greatest({n}, coalesce(max(strlen({x})), 0)) AS w_{f}" for f, (x, n) in fields.items())
    for f, (x, _) in fields.items():
        blanks = f"repeat(' ', (w_{f} - strlen({x}))::BIGINT)"
        line = line.replace(f"<{f}>", f"{x} || {blanks}").replace(f">{f}<", f"{blanks} || {x}")
    return f"SELECT {keys}, {line} AS line FROM {rows}, (SELECT {wide} FROM {rows})"


_NAME = "coalesce(name, '')"


@register("export_mapping_text", O.with_([O.docs_cte("pages")], _fixed_sql(
    "docs", "doc_id", {"id": ("CAST(doc_id AS VARCHAR)", R.WIDTH_DOC_ID), "base": (f"split_part({_NAME}, '.', 1)", R.WIDTH_FILE_NAME),
                       "ext": (f"split_part({_NAME}, '.', 2)", 0)}, "<id> || chr(9) || >base< || '.' || <ext>")))
def q_export_mapping_text(spark, sf):
    from .sources.index_store import mapping_text
    return mapping_text(_pages(spark, sf).select("doc_id", "name"))


@register("export_dictionary_text", O.with_(
    O.index_ctes("pages", "weighted", "once") + [f"d AS (SELECT term, num_docs, {_START} AS start FROM kept)"], _fixed_sql(
        "d", "term", {"t": ("term", R.WIDTH_TERM), "n": ("CAST(num_docs AS VARCHAR)", R.WIDTH_NUM_DOCS),
                      "s": ("CAST(start AS VARCHAR)", R.WIDTH_START)}, "<t> || chr(9) || <n> || chr(9) || <s>")))
def q_export_dictionary_text(spark, sf):
    from .sources.index_store import dictionary_text
    return dictionary_text(_weighted_pages(spark, sf).dictionary("start"))


@register("export_postings_text", O.with_(O.index_ctes("pages", "weighted", "once"), _fixed_sql(
    "post", "term, doc_id", {"id": ("CAST(doc_id AS VARCHAR)", R.WIDTH_DOC_ID), "w": ("printf('%.6f', weight)", R.WIDTH_WEIGHT)},
    "<id> || chr(9) || <w>")))
def q_export_postings_text(spark, sf):
    from .sources.index_store import postings_text
    return postings_text(_weighted_pages(spark, sf).postings)


@register("export_raw_text", O.with_(
    O.index_ctes("pages", "raw") + [f"d AS (SELECT term, num_docs, {_END} AS e FROM kept)"],
    "SELECT term, term || chr(9) || CAST(num_docs AS VARCHAR) || chr(9) || CAST(e AS VARCHAR) AS line FROM d"))
def q_export_raw_text(spark, sf):
    from .sources.index_store import raw_dictionary_text
    return raw_dictionary_text(build_index(_pages(spark, sf), "raw")).select("term", "line")


@register("export_raw_postings", O.with_(
    O.index_ctes("pages", "raw"),
    "SELECT term, doc_id, CAST(doc_id AS VARCHAR) || ' ' || chr(9) || ' ' || CAST(raw_freq AS VARCHAR) AS line FROM post"))
def q_export_raw_postings(spark, sf):
    from .sources.index_store import raw_postings_text
    return raw_postings_text(build_index(_pages(spark, sf), "raw")).select("term", "doc_id", "line")


# ---------------------------------------------------------------------------
# tokenizer
# ---------------------------------------------------------------------------
@register("line_counts", O.with_(
    [O.docs_cte("pages")],
    "SELECT doc_id, CAST(length(regexp_replace(coalesce(body, ''), '\\r\\n|\\r|\\n', 'x', 'g')) - "
    "length(regexp_replace(coalesce(body, ''), '\\r\\n|\\r|\\n', '', 'g')) + CASE WHEN length(coalesce(body, '')) > 0 "
    "AND right(body, 1) NOT IN (chr(10), chr(13)) THEN 1 ELSE 0 END AS BIGINT) AS lines FROM docs"))
def q_line_counts(spark, sf):
    return T.line_counts(_pages(spark, sf))


@register("lexeme_kinds", O.with_(_sql_kinded("pages"),
                                  "SELECT kind, count(*) AS lexemes FROM kx GROUP BY kind"))
def q_lexeme_kinds(spark, sf):
    return _kinded(_pages(spark, sf)).groupBy("kind").agg(F.count(F.lit(1)).alias("lexemes"))


def _kind_terms(kind: str, table: str):
    sql = O.with_(_sql_kinded(table), f"SELECT token AS term, count(*) AS n FROM kx WHERE kind = '{kind}' GROUP BY token")

    def run(spark, sf):
        coll = _pages(spark, sf) if table == "pages" else _documents(spark, sf)
        return (_kinded(coll).where(F.col("kind") == kind)
                .groupBy(F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("n")))
    return sql, run


for _key, _kind, _table in [("hyperlink_terms", "url", "pages"), ("number_terms", "number", "pages"),
                            ("email_terms", "email", "documents"), ("word_terms", "word", "pages")]:
    _sql, _run = _kind_terms(_kind, _table)
    register(_key, _sql)(_run)


@register("token_counts", O.with_(
    [O.docs_cte("documents"), O.tok_cte()],
    "SELECT doc_id, doc_len AS n_tokens, CAST(len(list_distinct(tokens)) AS BIGINT) AS n_distinct FROM tok"))
def q_token_counts(spark, sf):
    dt = T.document_tokens(_documents(spark, sf))
    return dt.select("doc_id", F.col("doc_len").alias("n_tokens"),
                     F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))


def _tokens_key(table: str, analyzer: str):
    sql = O.with_([O.docs_cte(table), O.tok_cte(analyzer)],
                  "SELECT doc_id, CAST(unnest(range(len(tokens))) AS BIGINT) AS pos, unnest(tokens) AS term FROM tok")

    def run(spark, sf):
        coll = _pages(spark, sf) if table == "pages" else _documents(spark, sf)
        return T.token_rows(coll, analyzer).select("doc_id", "pos", "term")
    return sql, run


for _key, _table, _an in [("tokens_pages", "pages", "full"), ("tokens_documents", "documents", "full"),
                          ("tokens_compact", "pages", "compact")]:
    _sql, _run = _tokens_key(_table, _an)
    register(_key, _sql)(_run)


# ---------------------------------------------------------------------------
# Filters, stemming, formatting
# ---------------------------------------------------------------------------
@register("min_length_filter", O.with_(
    _sql_pages_tok(), "SELECT doc_id, CAST(len(list_filter(tokens, lambda t: length(t) > 1)) AS BIGINT) AS kept FROM tok"))
def q_min_length_filter(spark, sf):
    dt = T.document_tokens(_pages(spark, sf))
    return dt.select("doc_id", F.size(F.filter("tokens", lambda t: F.length(t) > 1)).cast("long").alias("kept"))


@register("stopword_filter", O.with_(
    _sql_pages_tok(),
    f"SELECT doc_id, CAST(len(list_filter(tokens, lambda t: t NOT IN {O.STOPLIST})) AS BIGINT) AS kept FROM tok"))
def q_stopword_filter(spark, sf):
    dt = T.document_tokens(_pages(spark, sf))
    return dt.select("doc_id", F.size(F.filter("tokens", lambda t: ~t.isin(*R.STOPWORDS))).cast("long").alias("kept"))


@register("prune_rare_once", O.with_(O.index_ctes("pages", "weighted", "once"),
                                     "SELECT term, num_docs, coll_freq FROM kept"))
def q_prune_rare_once(spark, sf):
    return _weighted_pages(spark, sf, "once").terms


@register("prune_rare_tf_one", O.with_(O.index_ctes("pages", "weighted", "tf_one"),
                                       "SELECT term, num_docs, coll_freq FROM kept"))
def q_prune_rare_tf_one(spark, sf):
    return _weighted_pages(spark, sf, "tf_one").terms


@register("query_terms_lenient", O.with_(O.query_ctes("benchmark", "lenient"),
                                         "SELECT query_id, term, mult FROM qterms"))
def q_query_terms_lenient(spark, sf):
    return Q.query_terms(Q.query_tokens(_benchmark(spark, sf)), "lenient")


@register("query_rejects", O.with_(O.query_ctes("benchmark", "lenient"),
                                   "SELECT query_id, pos, token, reason FROM qtok WHERE reason IS NOT NULL"))
def q_query_rejects(spark, sf):
    return Q.query_rejects(Q.query_tokens(_benchmark(spark, sf)))


@register("query_terms_strict", O.with_(O.query_ctes("benchmark", "strict"),
                                        "SELECT query_id, term, mult FROM qterms"))
def q_query_terms_strict(spark, sf):
    return Q.query_terms(Q.query_tokens(_benchmark(spark, sf)), "strict")


def _stem_sql(x):
    from .functions.stemmer import stem_sql
    return stem_sql(x)


@register("stem_vocabulary", O.with_(
    O.index_ctes("pages", "weighted", None) + ["vocab AS (SELECT DISTINCT term FROM freq)"],
    f"SELECT term, {_stem_sql('term')} AS stem FROM vocab"))
def q_stem_vocabulary(spark, sf):
    from .functions.stemmer import stem
    vocab = frequencies(_pages(spark, sf), "weighted").select("term").distinct()
    return vocab.select("term", stem(F.col("term")).alias("stem"))


@register("search_formatted", O.with_(
    O.index_ctes("pages", "stemmed", "once") + O.query_ctes(QUERY_STEMMED, "strict", stemmed=True) + O.search_ctes(),
    "SELECT t.query_id, t.rank, d.name || ' ' || printf('%.4f', t.score) AS line FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_search_formatted(spark, sf):
    idx = _weighted_pages(spark, sf, "once", "stemmed")
    return S.formatted(S.search(idx, QUERY_STEMMED))


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------
@register("term_frequency", O.with_([O.docs_cte("documents"), O.tok_cte()] + O.freq_ctes("raw"),
                                    "SELECT doc_id, term, raw_freq FROM freq"))
def q_term_frequency(spark, sf):
    return frequencies(_documents(spark, sf), "raw").select("doc_id", "term", "raw_freq")


@register("doc_length", O.with_(_sql_pages_tok(), "SELECT doc_id, doc_len FROM tok"))
def q_doc_length(spark, sf):
    return T.doc_length(T.document_tokens(_pages(spark, sf)))


@register("valid_doc_length", O.with_(
    _sql_pages_tok(),
    f"SELECT doc_id, CAST(len(list_filter(tokens, lambda t: {O.valid_sql('t')})) AS BIGINT) AS valid_len FROM tok"))
def q_valid_doc_length(spark, sf):
    return T.valid_doc_length(T.document_tokens(_pages(spark, sf)))


@register("corpus_size", O.with_(
    _sql_pages_tok(),
    f"SELECT CAST(sum(doc_len) AS BIGINT) AS all_tokens, CAST(sum(len(list_filter(tokens, lambda t: {O.valid_sql('t')}))) "
    "AS BIGINT) AS valid_tokens, count(*) AS documents FROM tok"))
def q_corpus_size(spark, sf):
    return T.corpus_size(T.document_tokens(_pages(spark, sf)))


@register("document_frequency", O.with_(O.index_ctes("pages", "weighted", None), "SELECT term, num_docs FROM dfs"))
def q_document_frequency(spark, sf):
    return Wt.document_frequency(frequencies(_pages(spark, sf), "weighted")).select("term", "num_docs")


@register("posting_lists", O.with_(
    O.index_ctes("pages", "weighted", None),
    f"SELECT term, CAST(floor(doc_id / {Wt.BLOCK_DOCS}) AS BIGINT) AS block, "
    "string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(raw_freq AS VARCHAR), ' ' ORDER BY doc_id) "
    "AS postings FROM post GROUP BY term, block"))
def q_posting_lists(spark, sf):
    pl = Wt.posting_lists(_weighted_pages(spark, sf, None).postings, "raw_freq")
    text = F.array_join(F.transform("postings", lambda s: F.concat(s["doc_id"].cast("string"), F.lit(":"),
                                                                   s["freq"].cast("string"))), " ")
    return pl.select("term", "block", text.alias("postings"))


@register("index_stats", O.with_(O.index_ctes("pages", "weighted", "once"),
                                 "SELECT count(*) AS postings, count(DISTINCT term) AS terms FROM post"))
def q_index_stats(spark, sf):
    return Wt.index_stats(build_index(_pages(spark, sf), "weighted", prune="once", by_hash=True).postings)


# ---------------------------------------------------------------------------
# Weighting and index profiles
# ---------------------------------------------------------------------------
@register("relative_tf", O.with_(O.index_ctes("pages", "weighted", None), "SELECT doc_id, term, tf FROM post"))
def q_relative_tf(spark, sf):
    return _weighted_pages(spark, sf, None).postings.select("doc_id", "term", "tf")


@register("idf", O.with_(O.index_ctes("pages", "weighted", None),
                         "SELECT term, round(1 + log10(CAST((SELECT n_docs FROM n) AS DOUBLE) / num_docs), 6) AS idf FROM kept"))
def q_idf(spark, sf):
    idx = _weighted_pages(spark, sf, None)
    return idx.terms.select("term", _r6(Wt.idf_col(Wt.n_docs_scalar(idx.n_docs))).alias("idf"))


def _index_key(profile: str):
    prune = None if profile == "raw" else "once"
    sql = O.with_(O.index_ctes("pages", profile, prune) + [f"d AS (SELECT term, num_docs, {_START} AS start FROM kept)"],
                  "SELECT p.term, p.doc_id, p.raw_freq, round(p.weight, 6) AS weight, d.num_docs, d.start "
                  "FROM post p JOIN d ON p.term = d.term")

    def run(spark, sf):
        idx = build_index(_pages(spark, sf), profile, prune=prune, keep=_shared(spark, "counts"), by_hash=True)
        return idx.entries("start").select(
            "term", "doc_id", "raw_freq", _r6(F.col("weight")).alias("weight"), "num_docs", "start")
    return sql, run


for _p in ("raw", "weighted", "stemmed"):
    _sql, _run = _index_key(_p)
    register(f"index_{_p}", _sql)(_run)


# ---------------------------------------------------------------------------
# Q1-Q11: query side, benchmark against documents
# ---------------------------------------------------------------------------
_DOCS_Q = O.index_ctes("documents", "weighted", "once") + O.query_ctes("benchmark", "lenient")


@register("term_lookup", O.with_(_DOCS_Q + O.search_ctes(),
                                 "SELECT query_id, term, mult, doc_id, round(weight, 6) AS weight FROM matches"))
def q_term_lookup(spark, sf):
    idx = _docs_index(spark, sf)
    plan = S.query_plan(idx, _benchmark(spark, sf))
    return plan["matches"].select("query_id", "term", "mult", "doc_id", _r6(F.col("weight")).alias("weight"))


@register("missing_terms", O.with_(_DOCS_Q, "SELECT query_id, term FROM qterms WHERE term NOT IN (SELECT term FROM kept)"))
def q_missing_terms(spark, sf):
    terms = Q.query_terms(Q.query_tokens(_benchmark(spark, sf)))
    return Q.missing_terms(terms, _docs_index(spark, sf).of(terms.select("term").distinct()).terms)


@register("score_documents", O.with_(_DOCS_Q + O.search_ctes(),
                                     "SELECT query_id, doc_id, round(score, 6) AS score FROM scores"))
def q_score_documents(spark, sf):
    plan = S.query_plan(_docs_index(spark, sf), _benchmark(spark, sf))
    return plan["scores"].select("query_id", "doc_id", _r6(F.col("score")).alias("score"))


@register("top_k", O.with_(_DOCS_Q + O.search_ctes(), "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM top"))
def q_top_k(spark, sf):
    return _rounded(S.query_plan(_docs_index(spark, sf), _benchmark(spark, sf))["top"])


@register("search_stemmed", O.with_(
    O.index_ctes("pages", "stemmed", "once") + O.query_ctes(QUERY_STEMMED, "strict", stemmed=True) + O.search_ctes(),
    "SELECT t.query_id, t.rank, t.doc_id, d.name, round(t.score, 6) AS score FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_search_stemmed(spark, sf):
    return _rounded(S.search(_weighted_pages(spark, sf, "once", "stemmed"), QUERY_STEMMED))


@register("search_many", O.with_(
    _DOCS_Q + O.search_ctes(),
    "SELECT t.query_id, t.rank, t.doc_id, d.name, round(t.score, 6) AS score FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_search_many(spark, sf):
    return _rounded(S.search_many(_docs_index(spark, sf), _benchmark(spark, sf)))


@register("result_preview", O.with_(
    _DOCS_Q + O.search_ctes(),
    "SELECT t.query_id, t.rank, t.doc_id, d.body AS preview FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_result_preview(spark, sf):
    from .sources.index_store import read_documents, write_documents
    coll, queries = _documents(spark, sf), _benchmark(spark, sf)
    path = _shared(spark, "store")
    write_documents(coll, path)
    store = read_documents(spark, path)
    n = queries.count()
    res = S.search_many(_reopened(spark, sf), queries, n_queries=n)
    return Q.result_preview(res, store.documents, bound_rows=n * R.TOP_K, buckets=store.buckets).select(
        "query_id", "rank", "doc_id", "preview")


@register("queries_without_results", O.with_(
    O.index_ctes("documents", "stemmed", "once") + O.query_ctes("benchmark", "strict", stemmed=True) + O.search_ctes(),
    "SELECT query_id, text FROM qs WHERE query_id NOT IN (SELECT query_id FROM top)"))
def q_queries_without_results(spark, sf):
    coll = _documents(spark, sf)
    queries = _benchmark(spark, sf)
    res = S.search_many(build_index(coll, "stemmed", prune="once"), queries)
    return Q.queries_without_results(queries, res)


# ---------------------------------------------------------------------------
# The same on an index written to the shared folder and opened again
# ---------------------------------------------------------------------------
def _reopened(spark, sf):
    from .sources.index_store import read_index, write_index
    path = _shared(spark, "index")
    write_index(_docs_index(spark, sf), path)
    return read_index(spark, path)


@register("read_index", O.with_(O.index_ctes("documents", "weighted", "once"),
                                f"SELECT term, num_docs, coll_freq, {_START} AS start FROM kept"))
def q_read_index(spark, sf):
    return _reopened(spark, sf).terms


@register("search_reopened", SQL["search_many"])
def q_search_reopened(spark, sf):
    return _rounded(S.search_many(_reopened(spark, sf), _benchmark(spark, sf)))


# ---------------------------------------------------------------------------
# Result lines of the weighted stage's query tool
# ---------------------------------------------------------------------------
@register("search_lines", O.with_(
    O.index_ctes("pages", "weighted", None) + O.query_ctes(QUERY_WEIGHTED) + O.search_ctes(),
    "SELECT t.query_id, t.rank, 'docid: ' || t.doc_id || ', document name: ' || d.name || ', weight: ' || "
    "printf('%.6f', t.score) AS line FROM top t JOIN docs d ON t.doc_id = d.doc_id"))
def q_search_lines(spark, sf):
    return S.result_lines(S.search(build_index(_pages(spark, sf), "weighted", prune=None), QUERY_WEIGHTED), decimals=6)
