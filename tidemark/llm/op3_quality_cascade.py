"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule is a Boolean expression that says "reject". On a bounded sample every rule's
cost (seconds) and selectivity (share rejected of what earlier rules let through) are
measured; the cascade then asks the rules in descending rejection per cost, and a row that
is rejected is asked no further. The order cannot change which rows are kept.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WS_CLASS, store, table

#: words in the windows that n_repeat_words looks at
REPEAT_WINDOW = 8
#: rows of the sample that orders the rules
SAMPLE_ROWS = 1000
#: how often the sample is repeated in one timed run, and timed runs per rule
REPEATS, RUNS = 2, 3


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_CLASS), "")


def symbols_in(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")


def _lines_with_words(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))


def duplicate_lines(text: Column) -> Column:
    return _let(_lines_with_words(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column, window: int = REPEAT_WINDOW) -> Column:
    """Words covered by windows that are found twice or more in the same text, first ones included."""
    def hashes(one: Column) -> Column:
        # single elements are read in place; a slice would copy its array for every window
        n = F.size(one) - F.lit(window)
        return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n),
                                          lambda i: F.xxhash64(*[F.get(one, i + k) for k in range(window)])))

    def covered(h: Column) -> Column:
        tagged = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            def twin(x, k):
                return ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"]))
        begin = F.struct(F.lit(0).alias("total"), F.lit(-window).alias("last"))
        return F.aggregate(_let(tagged, starts), begin,
                           lambda acc, x: F.struct((acc["total"] + F.least(F.lit(window), x - acc["last"])).alias("total"),
                                                   x.alias("last")),
                           lambda acc: acc["total"])
    per_word = F.transform(words, lambda w: F.xxhash64(w))
    return F.coalesce(_let(_let(per_word, hashes), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
                           .otherwise(covered(h))), F.lit(0)).cast("long")


def stuttered_words(words: Column) -> Column:
    """Words that equal the word before them."""
    return _let(words, lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))).cast("long")


#: what the rules read, as expressions over text and words
MEASURES: dict[str, Callable[[], Column]] = {
    "n_words": lambda: F.size("words").cast("long"),
    "word_chars": lambda: F.length(F.array_join("words", "")).cast("long"),
    "n_symbols": lambda: symbols_in(F.col("text")),
    "n_dup_lines": lambda: duplicate_lines(F.col("text")),
    "n_repeat_words": lambda: repeated_words(F.col("words")),
    "n_stutter": lambda: stuttered_words(F.col("words")),
    "n_lines": lambda: F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).cast("long"),
}


@dataclass(frozen=True)
class Rule:
    """``reject(m)`` is true for a row to reject; ``m(name)`` gives a measure. Null counts as false."""
    name: str
    reject: Callable[[Callable[[str], Column]], Column]


#: fixed values: the contract's base rules, then wide limits in the manner of published web-text filters
FEW_WORDS = Rule("few_words", lambda m: m("n_words") < 20)
REPEATED_WORDS = Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words"))
MANY_SYMBOLS = Rule("many_symbols", lambda m: 10 * m("n_symbols") > m("n_words"))
SHORT_WORDS = Rule("short_words", lambda m: m("word_chars") < 2 * m("n_words"))
LONG_WORDS = Rule("long_words", lambda m: m("word_chars") > 15 * m("n_words"))
STUTTER = Rule("stutter", lambda m: 100 * m("n_stutter") > 30 * m("n_words"))
#: one or two repeated lines are common in short clean texts
DUPLICATE_LINES = Rule("duplicate_lines", lambda m: (m("n_dup_lines") >= 3) & (100 * m("n_dup_lines") > 30 * m("n_lines")))
BASE_RULES = (FEW_WORDS, REPEATED_WORDS)
RULES = BASE_RULES + (MANY_SYMBOLS, SHORT_WORDS, LONG_WORDS, STUTTER, DUPLICATE_LINES)


def _inline(name: str) -> Column:
    return MEASURES[name]()


def order_rules(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int = SAMPLE_ROWS,
                clock: Callable[[DataFrame], float] | None = None) -> list[Rule]:
    """The rules by descending rejection per cost, measured on at most ``sample_rows`` rows of ``docs`` (text).

    A rule's cost is the median time of several runs over the sample, repeated until a run
    is far longer than a job's start, less that of a run without a rule, and rounded to
    a power of two, so that noise does not turn the order. The rejection that counts is
    that of rows which the rules before it let through; equal gains keep the given order.
    ``clock(job)`` times one run.
    """
    n = docs.count()
    if n == 0 or len(rules) < 2:
        return list(rules)
    sample = store(docs.select("text").sample(min(1.0, 3.0 * sample_rows / n), seed=11).limit(sample_rows)
                   .select("text", words_of(F.col("text")).alias("words")), "rule_sample")
    # one row for each set of rules that reject the same rows: at most 2 ** rules, and at most the sample
    flags = [F.coalesce(r.reject(_inline), F.lit(False)).alias(f"r{k}") for k, r in enumerate(rules)]
    groups = [(tuple(row)[:-1], row["count"]) for row in sample.select(*flags).groupBy(*[f"r{k}" for k in range(len(rules))])
              .count().collect()]
    again = sample.withColumn("__tm_turn", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def cost(condition: Column) -> float:
        # the turn takes part, so that every repeated row is judged anew
        job = again.agg(F.count(F.when(condition & (F.col("__tm_turn") > 0), 1)).alias("hit"))
        return median((clock or _seconds)(job) for _ in range(RUNS))
    base = cost(F.lit(True))
    least = 0.05 * base
    costs = [2.0 ** round(math.log2(max(cost(r.reject(_inline)) - base, least))) for r in rules]
    left, out = list(range(len(rules))), []
    while left:
        best = max(left, key=lambda k: (sum(c for f, c in groups if f[k]) / costs[k], -costs[k], -k))
        out.append(rules[best])
        left.remove(best)
        groups = [(f, c) for f, c in groups if not f[best]]
    return out


def _seconds(job: DataFrame) -> float:
    t = time.perf_counter()
    job.first()
    return time.perf_counter() - t


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
            measures: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (any columns, with text) plus ``rejected_by``: the first rule, in the measured order, that rejects, or null.

    A rule's measures are computed inside its branch, so a rejected row skips the
    measures of all later rules. Measures named in ``measures`` are wanted for every row:
    they are computed once, returned as one struct column ``measures``, and read by the
    rules. Null text has no words; ties and repeated rows are judged one by one; an empty
    table gives an empty result. Which rows are rejected does not depend on the order;
    which rule is named does.
    """
    ordered = order_rules(docs, rules, sample_rows)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    base = docs.select(row, F.col("text"), words_of(F.col("text")).alias("words"))
    full = base.select("row", "text", "words", *[MEASURES[n]().alias(f"__tm_{n}") for n in measures])

    def measure(name: str) -> Column:
        return F.col(f"__tm_{name}") if name in measures else _inline(name)

    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.reject(measure), F.lit(rule.name)).otherwise(verdict)
    out = full.select("row", verdict.alias("__tm_by"), *([F.struct(*[F.col(f"__tm_{n}").alias(n) for n in measures])
                                                          .alias("__tm_measures")] if measures else []))
    kept = [F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*kept, F.col("__tm_by").alias("rejected_by"),
                      *([F.col("__tm_measures").alias("measures")] if measures else []))


def op3_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the measures, the base rules' verdict and the cascade's for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = cascade(docs, measures=("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    m = F.col("measures")
    base = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    return out.select("doc_id", m["n_words"].alias("n_words"), m["word_chars"].alias("word_chars"),
                      m["n_symbols"].alias("n_symbols"), m["n_dup_lines"].alias("n_dup_lines"),
                      m["n_repeat_words"].alias("n_repeat_words"), base.alias("base_failed"),
                      F.col("rejected_by").isNull().alias("kept"))


ORACLE = r"""
with w as (
  select doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') as words
  from documents),
win as (
  select doc_id, words[i:i + 7] as g, i
  from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from win) where n > 1),
rep as (
  select doc_id, count(distinct k) as n_repeat_words
  from (select doc_id, unnest(range(i, i + 8)) as k from twice) group by doc_id),
m as (
  select w.doc_id, cast(len(words) as bigint) as n_words,
         cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) as lines,
         len(string_split(t, chr(10))) as n_lines,
         len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) as n_stutter,
         coalesce(n_repeat_words, 0) as n_repeat_words
  from w left join rep using (doc_id)),
d as (select * exclude (lines), cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines from m),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from d)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 100 * n_stutter > 30 * n_words or (n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines)) as kept
from b
"""
