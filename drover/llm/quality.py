"""Quality rules as a short-circuit cascade, with DataFrame functions only.

:func:`text_features` adds the word and line counts that the base rules need.
:func:`cascade` runs further rules over what the base leaves. Each rule's cost (time on a
sample) and selectivity (share that it rejects there) are estimated first; the rules then
run in order of rejection per cost, and a document that one rule rejects skips the rest.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from drover.llm.common import written

_WS = " \t\n\x0b\x0c\r"
_SPLIT = "[ \\t\\n\\x0b\\f\\r]+"
WINDOW = 8
#: Rows of the sample that costs and selectivities are estimated on (expected number).
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def text_features(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with <prefix>words (array), n_words, word_chars, n_symbols, n_lines,
    n_dup_lines and n_repeat_words of whole texts (null: no words)."""
    c = lambda name: prefix + name
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(_WS))
    n = F.col(c("n_words"))
    d = docs.withColumn(c("words"), F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPLIT)))
    d = d.withColumns({
        c("n_words"): F.size(c("words")).cast("long"),
        c("word_chars"): F.char_length(F.array_join(c("words"), "")).cast("long"),
        c("n_symbols"): (F.octet_length(text) - F.octet_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long"),
        c("lines"): F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_WS)) != "")})
    d = d.withColumns({
        c("n_lines"): F.size(c("lines")).cast("long"),
        c("n_dup_lines"): (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        c("grams"): F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n.cast("int") - (WINDOW - 1)),
                                                    lambda i: F.xxhash64(F.slice(c("words"), i, WINDOW))))})
    # the places of windows that occur twice or more: neighbours in the order of their hashes
    some = F.size(F.array_distinct(c("grams"))) < F.size(c("grams"))
    d = d.withColumn(c("sorted"), F.when(some, F.array_sort(F.transform(c("grams"), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    s = F.col(c("sorted"))
    at = lambda i: F.get(s, i)["g"]
    d = d.withColumn(c("at"), F.when(s.isNotNull(), F.array_sort(F.transform(
        F.filter(s, lambda e, i: e["g"].eqNullSafe(at(i + 1)) | e["g"].eqNullSafe(at(i - 1))), lambda e: e["i"]))))
    p = F.col(c("at"))
    # each such window covers its words up to the next one's first word
    total = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                        F.lit(0), lambda a, b: a + b)
    # The row number keeps filters on the results above this projection: pushed below it,
    # they would inline the arrays into every step of the lambdas.
    d = d.withColumn(c("n_repeat_words"), F.when(F.monotonically_increasing_id() >= 0, F.when(p.isNull(), F.lit(0)).otherwise(total)).cast("long"))
    return d.drop(*(c(x) for x in ("lines", "grams", "sorted", "at")))


def base_failed(prefix: str = "") -> Column:
    n = F.col(prefix + "n_words")
    return (n < 20) | (100 * F.col(prefix + "n_repeat_words") > 30 * n)


def default_rules(prefix: str = "") -> list[Rule]:
    """Thresholds lie outside what clean prose reaches in any of its lengths."""
    words, n, chars = F.col(prefix + "words"), F.col(prefix + "n_words"), F.col(prefix + "word_chars")
    return [
        Rule("symbols", 20 * F.col(prefix + "n_symbols") > chars),
        Rule("repeated_lines", 5 * F.col(prefix + "n_dup_lines") > 2 * F.col(prefix + "n_lines")),
        Rule("word_length", (10 * chars < 28 * n) | (10 * chars > 105 * n)),
        Rule("letters", 100 * F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))) < 55 * n),
        Rule("stutter", 10 * F.size(F.filter(words, lambda w, i: w == F.get(words, i - 1))) > 3 * n)]


def ordered(rules: list[Rule], sample: DataFrame) -> list[Rule]:
    """Rules by rejections per second on ``sample``; a rule that rejects nothing there
    comes last (the cheapest first)."""
    n = max(1, sample.count())
    found = []
    for r in rules:
        seconds = []
        for _ in range(2):           # the first run also compiles
            began = time.perf_counter()
            hit = sample.agg(F.coalesce(F.sum(F.coalesce(r.rejects, F.lit(False)).cast("long")), F.lit(0))).first()[0]
            seconds.append(time.perf_counter() - began)
        found.append((-(hit / n) / min(seconds), min(seconds), r))
    return [r for _, _, r in sorted(found, key=lambda x: x[:2])]


def cascade(docs: DataFrame, rules: list[Rule], features: Callable[[DataFrame], DataFrame] = lambda d: d,
            name: str = "rejected_by", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``features(docs)`` with column ``name``: the first rule, in the cascade's order, that
    rejects the row, else null. A rule whose condition is null doesn't reject. The sample is
    drawn from ``docs``, so features of the rest are worked out once."""
    rows = docs.count()
    share = min(1.0, sample_rows / rows) if rows else 1.0
    drawn = written(docs.sample(share, seed=17), "rule-rows")    # else a sample above the features computes all of them
    order = ordered(rules, written(features(drawn), "rule-sample"))
    df = features(docs)
    verdict = F.lit(None).cast("string")
    for r in reversed(order):        # CASE evaluates conditions in order and stops
        verdict = F.when(r.rejects, F.lit(r.name)).otherwise(verdict)
    return df.withColumn(name, verdict)


def quality(docs: DataFrame, text_col: str = "text", prefix: str = "q_", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with <prefix>n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed, kept (boolean) and rejected_by.

    Defined cases: a null, empty or blank text has no words and fails the base; other
    columns, null or not, do not matter and are kept; the prefix keeps new names apart
    from those of ``docs`` (choose another if they clash); repeated rows get equal
    results; an empty table gives an empty result; texts are read whole.
    """
    clash = [c for c in docs.columns if c.startswith(prefix)] if prefix else []
    if clash:
        raise ValueError(f"columns {clash} begin with {prefix!r}")
    failed = base_failed(prefix)
    own = [Rule(r.name, ~failed & r.rejects) for r in (rules or default_rules(prefix))]
    # ~failed guards every rule, so what the base rejects skips them all
    judged = cascade(docs, own, lambda d: text_features(d, text_col, prefix), prefix + "rejected_by")
    return judged.withColumns({prefix + "base_failed": failed, prefix + "kept": ~failed & F.col(prefix + "rejected_by").isNull()}).drop(
        prefix + "words", prefix + "n_lines")
