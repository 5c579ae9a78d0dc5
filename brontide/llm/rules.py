"""Quality rules as a short-circuit cascade, in built-in expressions only.

Statistics of a text are columns; a rule is a condition under which a row is rejected. On a sample each rule
is timed and its rejections counted. Rules then run in falling order of rejections per cost, and a row
that one rejects is not looked at by those behind it. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brontide.llm.common import SPACES, replace_columns, uniform
from brontide.session import materialize

# Fixed values of the contract: characters that count as symbols, and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
_SPLIT = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``reject`` is SQL over ``__text`` and the statistics; null counts as false."""

    name: str
    reject: str


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float


# Conditions beyond the base; shares are given as integers, so that other engines agree exactly.
RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    Rule("word length", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    Rule("capitals", "5 * regexp_count(__text, '[A-Z]') > 2 * word_chars"),
    Rule("exclamations", "4 * (length(__text) - length(translate(__text, '!', ''))) > n_words"),
    Rule("repeated windows", "10 * n_repeat_words > 3 * n_words"),
    Rule("stutter", "5 * n_stutter > n_words"),
)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the text as ``__text``, null as empty, and its statistics.

    Added are ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines``,
    ``n_repeat_words`` and ``n_stutter`` (words equal to the word before), all bigint. Arrays that
    the lambdas read are columns of their own, used at least twice, so that they are built once a row.
    """
    # One 64-bit hash per word; windows of three are hashes of hashes.
    df = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("__w", F.expr(f"transform(array_remove(split(__text, '{_escaped(_SPLIT)}'), ''), x -> xxhash64(x))"))
    n = "size(__w)"
    df = df.withColumn("__t", F.expr(
        f"case when {n} >= 3 then zip_with(zip_with(slice(__w, 1, {n} - 2), slice(__w, 2, {n} - 2), (a, b) -> xxhash64(a, b)), "
        f"slice(__w, 3, {n} - 2), (p, c) -> xxhash64(p, c)) else array() end"))
    df = df.withColumn("__s", F.expr(
        "case when size(array_distinct(__t)) < size(__t) then sort_array(transform(__t, (h, i) -> struct(h, i))) end"))
    df = df.withColumn("__p", F.expr(
        "sort_array(array_compact(transform(__s, (x, k) -> case when x.h = get(__s, k - 1).h or x.h = get(__s, k + 1).h then x.i end)))"))
    bare = f"translate({{}}, '{_escaped(SPACES)}', '')"
    df = df.withColumn("__l", F.expr(f"filter(split(__text, '\\n'), x -> {bare.format('x')} <> '')"))
    statistics = {
        "n_words": n,
        "word_chars": f"length({bare.format('__text')})",
        "n_symbols": f"length(__text) - length(translate(__text, '{SYMBOLS}', ''))",
        "n_lines": "size(__l)",
        "n_dup_lines": "size(__l) - size(array_distinct(__l))",
        "n_repeat_words": "coalesce(aggregate(__p, struct(0 as n, -3 as last), "
                          "(s, i) -> struct(s.n + least(3, i - s.last) as n, i as last), s -> s.n), 0)",
        "n_stutter": f"case when {n} >= 2 then size(filter(zip_with(slice(__w, 1, {n} - 1), slice(__w, 2, {n} - 1), (a, b) -> a = b), x -> x)) else 0 end",
    }
    df = replace_columns(df, {k: F.expr(e).cast("long") for k, e in statistics.items()})
    return df.drop("__w", "__t", "__s", "__p", "__l")


def _escaped(text: str) -> str:
    """As the inside of an SQL string literal."""
    return "".join(f"\\u{ord(c):04x}" if ord(c) < 32 else "\\\\" if c == "\\" else c for c in text)


def estimate_rules(sample: DataFrame, rules: Sequence[Rule], runs: int = 2) -> list[Estimate]:
    """Cost in seconds above an empty pass, and the share rejected, of each rule on a stored sample."""
    def run(condition: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("int"))).first()[0]
        return time.perf_counter() - start, share or 0.0

    times = {r.name: [run(F.expr(r.reject)) for _ in range(runs)] for r in rules}
    empty = min(run(F.lit(False))[0] for _ in range(runs))
    return [Estimate(r, max(1e-4, min(t for t, _ in times[r.name]) - empty), times[r.name][0][1]) for r in rules]


def order_rules(estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules in falling order of rejections per second; ties by name."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.rejected / e.seconds, e.rule.name))]


def cascade(rules: Sequence[Rule], before: Column | None = None) -> Column:
    """False where ``before`` holds or a rule rejects, else true; later rules run on survivors only."""
    verdict = F.when(F.lit(False) if before is None else before, F.lit(False))
    for rule in rules:
        verdict = verdict.when(F.coalesce(F.expr(rule.reject), F.lit(False)), F.lit(False))
    return verdict.otherwise(F.lit(True))


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", rules: Sequence[Rule] = RULES,
          sample: int = 2000, seed: int = 3) -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``.

    ``sample`` is the expected number of rows that the order of the rules is estimated on. A null text
    has no words and so fails the base rules, as an empty one. Equal rows get equal verdicts. Columns
    named like the new ones are replaced. An empty table gives no rows.
    """
    share = min(1.0, sample / max(1, docs.count()))
    some = docs.filter(uniform(F.col(key), seed=seed) < share).select(F.col(text).alias("__source"))
    ordered = order_rules(estimate_rules(materialize(with_statistics(some, "__source"), "rules-sample"), rules))
    df = with_statistics(docs, text)
    base = F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words")
    df = replace_columns(df, {"base_failed": base})
    return replace_columns(df, {"kept": cascade(ordered, F.col("base_failed"))}).drop("__text")
