"""Porter's suffix-stripping stemmer as column expressions, no UDF.

``original`` is the algorithm of M. F. Porter, "An algorithm for suffix
stripping", Program 14(3), 1980. ``extended``, the default, adds the documented
extensions of a widely used natural-language library's default mode: a list of
irregular forms; ``ies`` and ``ied`` of four-letter words become ``ie``, other
``ied`` become ``i``; a final ``y`` changes only behind a consonant that isn't
the first letter; ``bli``, ``fulli`` and ``logi`` in step 2, which starts again
behind ``alli``; and two letters, vowel and consonant, count as a short stem.

Consonant/vowel runs follow the usual regex reading of the algorithm: a
consonant run is ``[^aeiou][^aeiouy]*`` and a vowel run ``[aeiouy][aeiou]*``,
which makes ``y`` a vowel exactly when it follows a consonant. An initial
``y`` is marked ``Y`` (a consonant) while stemming. Words of fewer than three
letters are returned unchanged; input is lower-cased first.

Each step binds its input once (``transform(array(w), ...)[0]``) so the
expression tree stays linear in the number of steps. ``stem_sql`` is the
same definition as DuckDB SQL text for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Measure patterns and suffix tables of the algorithm.
C = "[^aeiou][^aeiouy]*"
V = "[aeiouy][aeiou]*"
MGR0 = f"^({C})?{V}{C}"                  # m > 0
MEQ1 = f"^({C})?{V}{C}({V})?$"           # m = 1
MGR1 = f"^({C})?{V}{C}{V}{C}"            # m > 1
S_V = f"^({C})?[aeiouy]"                 # stem contains a vowel
CVC = f"^{C}[aeiouy][^aeiouwxy]$"        # m = 1 and ends consonant-vowel-consonant (not w, x, y)

STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
         ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
         ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
         ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
         ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism",
         "ate", "iti", "ous", "ive", "ize"]

# Fixed values of the extended mode.
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
             "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
             "exceed": "exceed", "succeed": "succeed"}
STEP2_EXTENDED = [x for x in STEP2 if x[0] not in ("abli", "alli")] + [("bli", "ble"), ("fulli", "ful")]
VC = "^[aeiou][^aeiou]$"
Y_AFTER = "^..*([^aeiouy]|[aeiou]y)$"    # ends in a consonant
MODES = ("extended", "original")

P1A_1 = "^(.+?)(ss|i)es$"
P1A_2 = "^(.+?)([^s])s$"
P1B_EED = "^(.+?)eed$"
P1B_ED = "^(.+?)(ed|ing)$"
P1C = "^(.+?)y$"
P2 = "^(.+?)(" + "|".join(s for s, _ in STEP2) + ")$"
P2X = "^(.+?)(" + "|".join(s for s, _ in STEP2_EXTENDED) + ")$"
P2_ALLI = "^(.+?)alli$"
P2_LOGI = "^(.+?)logi$"
P3 = "^(.+?)(" + "|".join(s for s, _ in STEP3) + ")$"
P4 = "^(.+?)(" + "|".join(STEP4) + ")$"
P4_ION = "^(.+?)(s|t)ion$"
P5 = "^(.+?)e$"


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body``."""
    return F.transform(F.array(value), body)[0]


def _g(w: Column, pattern: str, idx: int) -> Column:
    return F.regexp_extract(w, pattern, idx)


def _map(suffix: Column, table) -> Column:
    expr = None
    for s, r in table:
        expr = F.when(suffix == s, F.lit(r)) if expr is None else expr.when(suffix == s, F.lit(r))
    return expr


def _double_consonant(t: Column) -> Column:
    last = F.substring(t, -1, 1)
    return (F.length(t) >= 2) & (last == F.substring(t, -2, 1)) & ~last.rlike("[aeiouylsz]")


def _short(t, ext):
    return t.rlike(CVC) | t.rlike(VC) if ext else t.rlike(CVC)


def _step1a(w, ext):
    old = (F.when(w.rlike(P1A_1), F.regexp_replace(w, P1A_1, "$1$2"))
            .when(w.rlike(P1A_2), F.regexp_replace(w, P1A_2, "$1$2"))
            .otherwise(w))
    return F.when(w.rlike("^.ies$"), F.substring(w, 1, 3)).otherwise(old) if ext else old


def _step1b_tail(t, ext):
    return (F.when(t.rlike("(at|bl|iz)$"), F.concat(t, F.lit("e")))
            .when(_double_consonant(t), F.regexp_replace(t, ".$", ""))
            .when(_short(t, ext), F.concat(t, F.lit("e")))
            .otherwise(t))


def _step1b(w, ext):
    eed = _g(w, P1B_EED, 1)
    ed = _g(w, P1B_ED, 1)
    old = (F.when(w.rlike(P1B_EED), F.when(eed.rlike(MGR0), F.regexp_replace(w, ".$", "")).otherwise(w))
            .when(w.rlike(P1B_ED), F.when(ed.rlike(S_V), _let(ed, lambda t: _step1b_tail(t, ext))).otherwise(w))
            .otherwise(w))
    if not ext:
        return old
    return (F.when(w.rlike("^.ied$"), F.substring(w, 1, 3))
            .when(w.rlike("ied$"), F.regexp_replace(w, "..$", "")).otherwise(old))


def _step1c(w, ext):
    s = _g(w, P1C, 1)
    return F.when(w.rlike(P1C) & s.rlike(Y_AFTER if ext else S_V), F.concat(s, F.lit("i"))).otherwise(w)


def _step23(w, pattern, table):
    s, suf = _g(w, pattern, 1), _g(w, pattern, 2)
    return F.when(w.rlike(pattern) & s.rlike(MGR0), F.concat(s, _map(suf, table))).otherwise(w)


def _step2(w, ext):
    if not ext:
        return _step23(w, P2, STEP2)
    alli, logi = _g(w, P2_ALLI, 1), _g(w, P2_LOGI, 1)
    return (F.when(w.rlike(P2_ALLI) & alli.rlike(MGR0),
                   _let(F.concat(alli, F.lit("al")), lambda x: _step23(x, P2X, STEP2_EXTENDED)))
            .when(w.rlike(P2_LOGI), F.when(F.concat(logi, F.lit("l")).rlike(MGR0), F.concat(logi, F.lit("log"))).otherwise(w))
            .otherwise(_step23(w, P2X, STEP2_EXTENDED)))


def _step4(w):
    s = _g(w, P4, 1)
    si = F.concat(_g(w, P4_ION, 1), _g(w, P4_ION, 2))
    return (F.when(w.rlike(P4), F.when(s.rlike(MGR1), s).otherwise(w))
            .when(w.rlike(P4_ION), F.when(si.rlike(MGR1), si).otherwise(w))
            .otherwise(w))


def _step5(w, ext):
    s = _g(w, P5, 1)
    drop_e = w.rlike(P5) & (s.rlike(MGR1) | (s.rlike(MEQ1) & ~_short(s, ext)))
    w5 = F.when(drop_e, s).otherwise(w)
    return _let(w5, lambda x: F.when(x.rlike("ll$") & x.rlike(MGR1), F.regexp_replace(x, ".$", "")).otherwise(x))


def stem(term: Column, mode: str = "extended") -> Column:
    """Porter stem of ``term`` (lower-cased)."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    ext = mode == "extended"

    def run(w0):
        marked = F.when(F.substring(w0, 1, 1) == "y", F.concat(F.lit("Y"), F.substring(w0, 2, 1 << 30))).otherwise(w0)
        w = _let(marked, lambda x: _step1a(x, ext))
        w = _let(w, lambda x: _step1b(x, ext))
        w = _let(w, lambda x: _step1c(x, ext))
        w = _let(w, lambda x: _step2(x, ext))
        w = _let(w, lambda x: _step23(x, P3, STEP3))
        w = _let(w, _step4)
        w = _let(w, lambda x: _step5(x, ext))
        unmarked = _let(w, lambda x: F.when(F.substring(x, 1, 1) == "Y",
                                            F.concat(F.lit("y"), F.substring(x, 2, 1 << 30))).otherwise(x))
        out = F.when(F.length(w0) < 3, w0)
        if ext:
            for form, base in IRREGULAR.items():
                out = out.when(w0 == form, F.lit(base))
        return out.otherwise(unmarked)
    return _let(F.lower(term), run)


# ---------------------------------------------------------------------------
# DuckDB text of the same definition
# ---------------------------------------------------------------------------
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _m(x: str, p: str) -> str:
    return f"regexp_matches({x}, {_q(p)})"


def _gx(x: str, p: str, i: int) -> str:
    return f"regexp_extract({x}, {_q(p)}, {i})"


def _let_sql(value: str, var: str, body: str) -> str:
    return f"list_transform([{value}], lambda {var}: {body})[1]"


def _drop_last_sql(x: str) -> str:
    return f"regexp_replace({x}, '.$', '')"


def _map_sql(suf: str, table) -> str:
    return "CASE " + " ".join(f"WHEN {suf} = {_q(s)} THEN {_q(r)}" for s, r in table) + " END"


def stem_sql(term: str, mode: str = "extended") -> str:
    ext, v = mode == "extended", "w0"

    def short(x):
        return f"({_m(x, CVC)} OR {_m(x, VC)})" if ext else _m(x, CVC)

    marked = f"CASE WHEN substr({v}, 1, 1) = 'y' THEN 'Y' || substr({v}, 2) ELSE {v} END"
    s1a = (f"CASE WHEN {_m('a', P1A_1)} THEN regexp_replace(a, {_q(P1A_1)}, '\\1\\2') "
           f"WHEN {_m('a', P1A_2)} THEN regexp_replace(a, {_q(P1A_2)}, '\\1\\2') ELSE a END")
    if ext:
        s1a = f"CASE WHEN {_m('a', '^.ies$')} THEN substr(a, 1, 3) ELSE {s1a} END"
    dbl = ("(length(t) >= 2 AND substr(t, length(t), 1) = substr(t, length(t) - 1, 1) "
           "AND NOT regexp_matches(substr(t, length(t), 1), '[aeiouylsz]'))")
    tail = (f"CASE WHEN regexp_matches(t, '(at|bl|iz)$') THEN t || 'e' WHEN {dbl} THEN {_drop_last_sql('t')} "
            f"WHEN {short('t')} THEN t || 'e' ELSE t END")
    s1b = (f"CASE WHEN {_m('b', P1B_EED)} THEN (CASE WHEN regexp_matches({_gx('b', P1B_EED, 1)}, {_q(MGR0)}) "
           f"THEN {_drop_last_sql('b')} ELSE b END) "
           f"WHEN {_m('b', P1B_ED)} THEN (CASE WHEN regexp_matches({_gx('b', P1B_ED, 1)}, {_q(S_V)}) "
           f"THEN {_let_sql(_gx('b', P1B_ED, 1), 't', tail)} ELSE b END) ELSE b END")
    if ext:
        s1b = (f"CASE WHEN {_m('b', '^.ied$')} THEN substr(b, 1, 3) WHEN {_m('b', 'ied$')} "
               f"THEN regexp_replace(b, '..$', '') ELSE {s1b} END")
    s1c = (f"CASE WHEN {_m('c', P1C)} AND regexp_matches({_gx('c', P1C, 1)}, {_q(Y_AFTER if ext else S_V)}) "
           f"THEN {_gx('c', P1C, 1)} || 'i' ELSE c END")

    def s23(x, p, table):
        return (f"CASE WHEN {_m(x, p)} AND regexp_matches({_gx(x, p, 1)}, {_q(MGR0)}) "
                f"THEN {_gx(x, p, 1)} || {_map_sql(_gx(x, p, 2), table)} ELSE {x} END")

    s2 = s23("d", P2, STEP2)
    if ext:
        alli, logi = _gx("d", P2_ALLI, 1), _gx("d", P2_LOGI, 1)
        again = _let_sql(f"{alli} || 'al'", "k", s23("k", P2X, STEP2_EXTENDED))
        s2 = (f"CASE WHEN {_m('d', P2_ALLI)} AND regexp_matches({alli}, {_q(MGR0)}) THEN {again} "
              f"WHEN {_m('d', P2_LOGI)} THEN (CASE WHEN regexp_matches({logi} || 'l', {_q(MGR0)}) THEN {logi} || 'log' "
              f"ELSE d END) ELSE {s23('d', P2X, STEP2_EXTENDED)} END")

    si = f"({_gx('f', P4_ION, 1)} || {_gx('f', P4_ION, 2)})"
    s4 = (f"CASE WHEN {_m('f', P4)} THEN (CASE WHEN regexp_matches({_gx('f', P4, 1)}, {_q(MGR1)}) "
          f"THEN {_gx('f', P4, 1)} ELSE f END) "
          f"WHEN {_m('f', P4_ION)} THEN (CASE WHEN regexp_matches({si}, {_q(MGR1)}) THEN {si} ELSE f END) ELSE f END")
    g1 = _gx("g", P5, 1)
    s5a = (f"CASE WHEN {_m('g', P5)} AND (regexp_matches({g1}, {_q(MGR1)}) OR (regexp_matches({g1}, {_q(MEQ1)}) "
           f"AND NOT {short(g1)})) THEN {g1} ELSE g END")
    s5b = f"CASE WHEN regexp_matches(h, 'll$') AND {_m('h', MGR1)} THEN {_drop_last_sql('h')} ELSE h END"
    unmark = "CASE WHEN substr(i, 1, 1) = 'Y' THEN 'y' || substr(i, 2) ELSE i END"
    w = _let_sql(marked, "a", s1a)
    w = _let_sql(w, "b", s1b)
    w = _let_sql(w, "c", s1c)
    w = _let_sql(w, "d", s2)
    w = _let_sql(w, "e", s23("e", P3, STEP3))
    w = _let_sql(w, "f", s4)
    w = _let_sql(w, "g", s5a)
    w = _let_sql(w, "h", s5b)
    w = _let_sql(w, "i", unmark)
    forms = "".join(f"WHEN {v} = {_q(a)} THEN {_q(b)} " for a, b in IRREGULAR.items()) if ext else ""
    body = f"CASE WHEN length({v}) < 3 THEN {v} {forms}ELSE {w} END"
    return _let_sql(f"lower({term})", v, body)
