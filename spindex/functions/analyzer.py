"""The analyzer as Spark column expressions, all of them in the JVM.

A document body is scanned with one ``regexp_extract_all`` per line over the
ordered alternation

    IGNORE+ | dropped rules | ( emitted rules ) | dropped rules

whose leftmost-first semantics reproduce "at each position skip an ignored
character, else try the rules in order, first match wins; skip a character
nothing matches". Only the emitted rules (hyperlink, number, e-mail, word)
sit in capture group 1, so ignored runs and dropped lexemes (CSS, entity,
tag) come back empty and are removed with ``array_remove``: the array holds
one raw lexeme per token, and a document's token count is its size.

Three rules would be tried again and again over a long stretch in which they
can't match: the CSS rule, the e-mail rule and an unclosed tag. Where they
match has a closed form, so ``marked`` first puts marks into the line, in a few
linear passes:

- a tag opens at a '<' unless that stands behind the line's last '>';
- the CSS rule matches from a character if, later in the same comma-joined
  region or right behind it, there is a '{' that a block follows (some other
  character than '}', and a '}' later in the line); it goes on to the first '}'
  behind the last such '{';
- the e-mail rule matches from a character if a later '@' of the same unspaced
  run has something between it and the run's last '.' with a tail; it ends with
  that tail.

The scan then needs no backtracking: each rule is tried where it matches, or
fails at its first character. Time is linear in the line.

Normalizing a lexeme needs its rule: the first emitted rule that matches at
its start (no rule looks past its own match, so this is exact); an e-mail keeps
its mark as first character. ``token_of`` is an ordinary column expression,
so after an explode it runs inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R


def line_pattern(analyzer: str = "full", form: str = "java") -> str:
    """The scan pattern: ``java`` for a marked line, ``plain`` for one without
    marks, ``re2`` for the oracle. Group 0 is every lexeme (ignored runs and
    dropped kinds included), group 1 the lexemes of emitted rules."""
    rules = [r for r in R.RULE_SETS[analyzer] if getattr(r, form) is not None]
    emitted = [i for i, r in enumerate(rules) if r.emit]
    lo, hi = emitted[0], emitted[-1]
    if any(not r.emit for r in rules[lo:hi + 1]):
        raise ValueError("emitted rules must be contiguous in scan order")
    pat = [f"(?:{getattr(r, form)})" for r in rules]
    ignore = {"java": R.IGNORE_JAVA, "plain": R.IGNORE_PLAIN, "re2": R.IGNORE_CLASS + "+"}[form]
    return "|".join([f"(?:{ignore})", *pat[:lo], "(" + "|".join(pat[lo:hi + 1]) + ")", *pat[hi + 1:]])


# -- marks -----------------------------------------------------------------
def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _has(x: Column, what: str) -> Column:
    return F.instr(x, what) > 0


def _without(x: Column, tail: Column, more: int = 0) -> Column:
    """``x`` without its end ``tail`` and ``more`` characters before that."""
    return F.substring(x, F.lit(1), F.length(x) - F.length(tail) - more)


def _marked_each(x: Column, mark: str) -> Column:
    return F.regexp_replace(x, f"([^{R.BLANK}])", mark + "$1")


def _mark_open(line: Column) -> Column:
    """'<' behind the last '>' can't open a tag."""
    tail = F.substring_index(line, ">", -1)
    return F.when(_has(line, "<"), _let(tail, lambda t: F.when(
        _has(t, "<"), F.concat(_without(line, t), F.replace(t, F.lit("<"), F.lit(R.M_OPEN)))).otherwise(line))).otherwise(line)


# a comma-joined region with the blanks behind it, or the blanks that begin a line
_REGION = f"[^{R.BLANK}]++(?:(?<=,)[{R.BLANK}]++[^{R.BLANK}]++)*+[{R.BLANK}]*+|[{R.BLANK}]++"


def _mark_css(line: Column) -> Column:
    tail = F.substring_index(line, "}", -1)
    braces = _let(tail, lambda t: F.concat(F.regexp_replace(_without(line, t), r"\{(?!\})", R.M_ANY), t))

    def region(regions: Column, r: Column, i: Column) -> Column:
        following = F.coalesce(F.get(regions, i + 1), F.lit(""))
        before = F.coalesce(F.get(regions, i - 1), F.lit(""))
        word = lambda x: x.rlike(f"^[^{R.BLANK}]")
        led = word(before) & r.startswith(R.M_ANY)      # its first '{' ends a match of the region before
        plain = lambda x: F.replace(x, F.lit(R.M_ANY), F.lit("{"))
        last = lambda x: F.substring_index(x, R.M_ANY, -1)
        own = _let(F.when(led, F.substring(r, F.lit(2), F.length(r))).otherwise(r), lambda x: F.when(
            word(r) & following.startswith(R.M_ANY), _marked_each(plain(x), R.M_CSS)).when(
            _has(x, R.M_ANY), F.concat(_marked_each(plain(_without(x, last(x), 1)), R.M_CSS),
                                       F.lit(R.M_BRACE), last(x))).otherwise(x))
        return F.concat(F.when(led, F.lit(R.M_BRACE)).otherwise(F.lit("")), own)

    def regions(head: Column) -> Column:
        return _let(F.regexp_extract_all(head, F.lit(_REGION), 0),
                    lambda rs: F.array_join(F.transform(rs, lambda r, i: region(rs, r, i)), ""))

    # behind the last such '{' nothing is marked: only what is before is taken apart
    done = _let(braces, lambda b: F.when(_has(b, R.M_ANY), _let(
        F.substring_index(b, R.M_ANY, -1), lambda t: F.concat(regions(_without(b, t)), t))).otherwise(line))
    return F.when(_has(line, "{") & _has(line, "}"), done).otherwise(line)


def _mark_mail(line: Column) -> Column:
    def run(r: Column) -> Column:
        # where the CSS rule matches it comes first; what follows its brace may hold an e-mail
        own = F.substring_index(r, R.M_BRACE, -1)
        own = F.when(_has(own, R.M_CSS), F.lit("")).otherwise(own)

        def dotted(p: Column, d: Column) -> Column:
            before, after = F.substring_index(d, R.M_DOT, 1), F.substring_index(d, R.M_DOT, -1)
            inner = F.substring(before, F.lit(1), F.length(before) - 1)  # '@' has something behind it
            host = F.substring_index(inner, "@", -1)
            return F.when(_has(d, R.M_DOT) & _has(inner, "@"), F.concat(
                _without(r, p), _marked_each(_without(inner, host, 1), R.M_MAIL), F.lit("@"), host,
                F.substring(before, F.length(before), F.lit(1)), F.lit(R.M_DOT), after)).otherwise(r)

        found = _let(own, lambda p: _let(
            F.regexp_replace(p, rf"^([^{R.BLANK}]*)\.(?={R.MAIL_TAIL})", "$1" + R.M_DOT), lambda d: dotted(p, d)))
        return F.when(_has(r, "@"), found).otherwise(r)

    runs = F.regexp_extract_all(line, F.lit(f"[^{R.BLANK}]++|[{R.BLANK}]++"), 0)
    return F.when(_has(line, "@"), F.array_join(F.transform(runs, run), "")).otherwise(line)


def marked(line: Column, analyzer: str = "full") -> Column:
    """The line with marks at the places where the CSS and e-mail rules match
    and where a tag can't (see ``rules.MARKS``)."""
    css = any(r.kind == "css" for r in R.RULE_SETS[analyzer])
    return _let(_mark_open(line), lambda x: _let(_mark_css(x) if css else x, _mark_mail))


def restored(lexeme: Column) -> Column:
    """A lexeme without its marks (no ASCII text has any)."""
    return F.when(F.octet_length(lexeme) == F.length(lexeme), lexeme).otherwise(
        F.translate(lexeme, R.M_BRACE + R.M_OPEN + R.M_DOT + R.M_CSS + R.M_MAIL, "{<."))


_ANY_MARK = f"[{R.M_CSS}{R.M_BRACE}{R.M_OPEN}{R.M_MAIL}{R.M_DOT}]"


def line_lexemes(line: Column, analyzer: str = "full", group: int = 1) -> Column:
    """array<string> of one line's lexemes (see ``lexemes``)."""
    def scan(x: Column) -> Column:
        raw = F.regexp_extract_all(x, F.lit(line_pattern(analyzer)), group)
        if group == 1:  # an e-mail keeps the mark it begins with, which tells its rule
            raw = F.transform(raw, lambda y: F.when(y.startswith(R.M_MAIL), F.concat(
                F.lit(R.M_MAIL), restored(y))).otherwise(restored(y)))
        return F.when(x.rlike(_ANY_MARK), raw).otherwise(
            F.regexp_extract_all(x, F.lit(line_pattern(analyzer, "plain")), group))

    special = line.rlike("[<{@]")
    return F.when(special, _let(marked(line, analyzer), scan)).otherwise(
        F.regexp_extract_all(line, F.lit(line_pattern(analyzer, "plain")), group))


def split_lines(body: Column) -> Column:
    """Universal-newline split; a NULL body reads as empty text."""
    text = F.coalesce(body, F.lit(""))
    return F.when(_has(text, "\n") | _has(text, "\r"), F.split(text, R.LINE_SPLIT)).otherwise(F.array(text))


def lexemes(body: Column, analyzer: str = "full", by_line: bool = True, group: int = 1) -> Column:
    """array<string>: a document's lexemes in order.

    ``group`` 1 (default): one raw lexeme per token (emitted rules only).
    ``group`` 0: every lexeme, ignored runs and dropped kinds included, with marks.
    ``by_line`` False scans the text as one string, as a query is read.
    """
    text = F.coalesce(body, F.lit(""))
    text = F.when(reduce(or_, (_has(text, m) for m in R.MARKS)), F.translate(text, R.MARKS, R.NO_MARK * len(R.MARKS))).otherwise(text)
    if not by_line:
        arr = line_lexemes(text, analyzer, group)
    else:
        arr = F.flatten(F.transform(split_lines(text), lambda l: line_lexemes(l, analyzer, group)))
    return F.array_remove(arr, "") if group == 1 else arr


def _starts_with_rule(x: Column, r: R.Rule) -> Column:
    """Whether an unmarked lexeme was found by rule ``r`` (entity, tag,
    hyperlink or number), told by its beginning."""
    if r.kind == "entity":
        return x.rlike("^&[" + R.WORDCH + "]")
    if r.kind == "tag":
        return x.rlike("^" + R.TAG_PLAIN)
    if r.kind == "number":
        # first character in 1-9: binary string order, ':' follows '9'
        return (x >= F.lit("1")) & (x < F.lit(":"))
    return (x.startswith("h") | x.startswith("w")) & x.rlike("^(?:" + r.plain + ")")


def _is_ignored(x: Column) -> Column:
    return F.instr(F.lit(R.IGNORE_CHARS), F.substring(x, 1, 1)) > 0


def lexeme_kind(x: Column, analyzer: str = "full") -> Column:
    """Name of the rule that produced a group-0 lexeme ('ignore' for skipped runs)."""
    own = restored(x)
    expr = F.when(_is_ignored(own), F.lit("ignore"))
    for r in R.RULE_SETS[analyzer]:
        if r.kind == "word":
            cond = own.rlike("^[A-z]") & ~x.startswith(R.M_MAIL)
        else:
            mark = {"css": R.M_CSS, "email": R.M_MAIL}.get(r.kind)
            cond = x.startswith(mark) if mark else _starts_with_rule(own, r)
        expr = expr.when(cond, F.lit(r.kind))
    return expr.otherwise(F.lit("unmatched"))


def normalize(x: Column, norm: str) -> Column:
    """Normalizer of an emitted lexeme."""
    if norm == "url":
        return F.regexp_replace(F.lower(x), R.URL_STRIP, "")
    if norm == "url_compact":
        return F.regexp_replace(F.lower(x), R.URL_STRIP_COMPACT, "")
    if norm == "number":
        return F.regexp_replace(x, R.NUMBER_STRIP, "")
    if norm == "keep":
        return x
    if norm == "email_compact":
        return F.regexp_replace(x, R.EMAIL_STRIP_COMPACT, "")
    if norm == "word":
        # without an inline tag the strip pattern removes single characters,
        # which ``translate`` does without a regex
        low = F.lower(x)
        return F.when(F.instr(x, "<") > 0, F.regexp_replace(low, R.WORD_STRIP, "")) \
            .otherwise(F.translate(low, R.WORD_STRIP_CHARS, ""))
    raise ValueError(norm)


def token_of(x: Column, analyzer: str = "full") -> Column:
    """Token of a raw (group-1) lexeme: the first emitted rule matching at its
    start decides the normalizer; the last emitted rule needs no test."""
    emitted = [r for r in R.RULE_SETS[analyzer] if r.emit]
    mail = x.startswith(R.M_MAIL)  # begins where the e-mail rule matches; an earlier rule may have
    own = F.when(mail, F.substring(x, F.lit(2), F.length(x))).otherwise(x)
    expr = None
    for r in emitted[:-1]:
        cond = mail if r.kind == "email" else _starts_with_rule(own, r)
        value = normalize(own, r.norm)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    last = normalize(x, emitted[-1].norm)
    return last if expr is None else expr.otherwise(last)


def tokens(body: Column, analyzer: str = "full", by_line: bool = True) -> Column:
    """array<string>: the token stream of a document, in order."""
    return F.transform(lexemes(body, analyzer, by_line), lambda x: token_of(x, analyzer))


def kept_lexeme(x: Column) -> Column:
    """A group-0 lexeme without its marks, but for the one that an e-mail begins with."""
    return F.when(x.startswith(R.M_MAIL), F.concat(F.lit(R.M_MAIL), restored(x))).otherwise(restored(x))


def kinded_lexemes(body: Column, analyzer: str = "full") -> Column:
    """array<struct<kind, lexeme>>, ignored runs and dropped kinds included; an
    e-mail's lexeme keeps its mark, as ``token_of`` takes it."""
    return F.transform(
        lexemes(body, analyzer, group=0),
        lambda x: F.struct(lexeme_kind(x, analyzer).alias("kind"), kept_lexeme(x).alias("lexeme")),
    )


def is_valid_term(t: Column) -> Column:
    """Index filter of the weighted profiles: longer than one character, not a stopword."""
    return (F.length(t) > 1) & ~t.isin(*R.STOPWORDS)


def valid_tokens(toks: Column) -> Column:
    return F.filter(toks, is_valid_term)
