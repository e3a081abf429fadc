"""Quality rules with risk-controlled thresholds: cutoffs are chosen on labelled holdouts so that, with a
stated confidence, each stratum rejects no more than a stated share of its good documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwatch.llm.common import BLANKS, body, documents, labels, let, saved

# The base rules.
FEWEST_WORDS = 50
MOST_REPEATS_PCT = 50
SYMBOLS = "[#*$%&|<>]"

#: Rules of the method: a document is rejected where a value exceeds its cutoff. The candidate cutoffs are set
#: beforehand, from lenient to strict; those of all rules at one place make up a step.
RULES = {
    "symbols_per_word": ("n_symbols", "n_words", (3.0, 2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "marks_per_word": ("n_marks", "n_words", (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2)),
    "capitals_share": ("n_capitals", "word_chars", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeats_share": ("n_repeat_words", "n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "duplicate_lines_share": ("n_dup_lines", "n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
}
#: All rules together may reject this share of the good documents of a stratum ...
RISK = 0.05
#: ... in any stratum, but for this probability.
ERROR = 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words which is found at least twice in the text."""
    def positions(windows: Column) -> Column:
        twin = lambda x, i: (F.get(windows, i - 1)["h"].eqNullSafe(x["h"])
                             | F.get(windows, i + 1)["h"].eqNullSafe(x["h"]))
        return F.sort_array(F.transform(F.filter(windows, twin), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    count = let(F.sort_array(windows), lambda s: let(positions(s), covered))
    return F.when(F.size(words) >= 3, count).otherwise(0)


def _of_words(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _repeat_words(words).cast("long").alias("n_repeat_words"))


def text_counts(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, `others` and the counts of each text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines (lines with a word), n_marks ([!?]), n_capitals. All expressions run per row, on whole
    texts; words of windows are compared by a 64-bit hash within their document. A null text has no words."""
    words = F.filter(F.split("body", BLANKS), lambda w: w != "")
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda pattern: F.regexp_count("body", F.lit(pattern)).cast("long")
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    rows = docs.select("doc_id", *others, body().alias("body"))
    rows = rows.select(
        "doc_id", *others, let(words, _of_words).alias("w"), of_lines.alias("l"), count(SYMBOLS).alias("n_symbols"),
        count("[!?]").alias("n_marks"), count(r"\p{Lu}").alias("n_capitals"))
    return rows.select("doc_id", *others, "w.*", "l.*", "n_symbols", "n_marks", "n_capitals")


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS_PCT * F.col("n_words"))


def log_binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """log P(X <= k) for X ~ Binomial(n, risk), exact but for rounding, for k below n * risk; the terms
    are summed by their logarithms."""
    odds = math.log(risk) - math.log1p(-risk)
    none = n * math.log1p(-risk)

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(acc["total"], term), F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    first = F.struct(none.alias("term"), none.alias("total"))
    total = F.aggregate(F.sequence(F.lit(1), k.cast("int")), first, add, lambda a: a["total"])
    return F.when(k < 1, none).otherwise(total)


STEPS = len(RULES["symbols_per_word"][2])


def _value(rule: str) -> Column:
    return F.try_divide(*RULES[rule][:2])


def first_step() -> Column:
    """The most lenient step that rejects a document, STEPS if none does."""
    found = F.lit(STEPS)
    for i in reversed(range(STEPS)):
        out = F.lit(False)
        for rule, (_, _, candidates) in RULES.items():
            out = out | F.coalesce(_value(rule) > candidates[i], F.lit(False))
        found = F.when(out, i).otherwise(found)
    return found


def safe_steps(counts: DataFrame, marked: DataFrame, stratum: str = "stratum", risk: float = RISK,
               error: float = ERROR) -> DataFrame:
    """One row per stratum that has a safe step which rejects a bad document: the stratum and that step.

    counts: text_counts with the stratum, marked: doc_id, quality. All labelled documents that pass the base
    rules are the holdout; nothing was fitted before, the steps are fixed. A step is safe if the exact binomial tail
    refutes, at level error / strata, that it rejects more than `risk` of the stratum's good documents. Steps are
    tested from lenient to strict, up to the first that is not refuted: such a fixed sequence needs no correction for
    its length, and what a step rejects the next one rejects too. So, but for probability `error`, every safe step
    of every stratum is truly safe (Bonferroni over the strata), whichever is then picked; with four strata some 90 good
    documents are enough for a first one. Picked is the safe step with the largest share of bad documents rejected
    less that of good ones, of equal ones the most lenient."""
    quality = marked.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    quality = quality.withColumnRenamed("doc_id", "marked_id")
    held = counts.where(~base_failed()).join(quality, F.col("doc_id") == F.col("marked_id"))
    good, at = F.col("quality") == 1, first_step()
    steps = [F.struct(
        F.lit(i).alias("step"), F.count_if(good & (at <= i)).alias("k"), F.count_if(~good & (at <= i)).alias("b"))
        for i in range(STEPS)]
    held = held.groupBy(stratum).agg(
        F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.array(*steps).alias("steps"))
    held = saved(held.where("good > 0"), "rule-steps")
    level = math.log(error / max(1, held.count()))
    tests = held.select(stratum, "good", "bad", F.inline("steps"))
    # k grows from step to step, and the tail with it: the steps that pass are the first ones
    tests = tests.where((F.col("k") < F.col("good") * risk) & (F.col("b") > 0))
    tests = tests.where(log_binomial_tail(F.col("good"), F.col("k"), risk) <= level)
    gain = F.col("b") / F.col("bad") - F.col("k") / F.col("good")
    best = F.max(F.when(gain > 0, F.struct(gain.alias("gain"), (-F.col("step")).alias("lenient"))))
    return tests.groupBy(stratum).agg((-best["lenient"]).alias("step")).where("step IS NOT NULL")


def judged(docs: DataFrame, marked: DataFrame, stratum: str = "lang", risk: float = RISK,
           error: float = ERROR) -> DataFrame:
    """One row per row of docs(doc_id, text, stratum): doc_id, the base counts, base_failed, kept, failed_rules.

    A document is kept if it passes the base rules and exceeds no cutoff of the step picked for its stratum. Null strata
    are a stratum of their own; a stratum without enough labels has no step, so that only the base rules hold. Labels
    that contradict each other count as good; labels without a document, a doc_id or a quality count for nothing. Rows
    that repeat a doc_id are judged each by its text. Other columns are ignored."""
    counts = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    counts = saved(text_counts(counts, "stratum"), "text-counts")
    picked = safe_steps(counts, marked, "stratum", risk, error)
    rows = counts.join(picked, "stratum", "left")
    failed = F.filter(F.array(*[
        F.when(_value(rule) > F.get(F.array(*map(F.lit, candidates)), F.col("step")), F.lit(rule))
        for rule, (_, _, candidates) in RULES.items()]), lambda rule: rule.isNotNull())
    rows = rows.withColumn("base_failed", base_failed()).withColumn("failed", failed)
    return rows.select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"),
        F.array_join("failed", ",").alias("failed_rules"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir), labels(spark, sf_dir))


def _sql_failed(i: str) -> dict[str, str]:
    lists = {rule: "[" + ", ".join(map(str, candidates)) + "]" for rule, (_, _, candidates) in RULES.items()}
    return {rule: f"{top} / nullif({under}, 0)::DOUBLE > {lists[rule]}[{i}]" for rule, (top, under, _) in RULES.items()}


ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM texts))),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r),
counts AS (
  SELECT t.r, doc_id, stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(p.n, 0) AS n_repeat_words, len(lines) AS n_lines, len(regexp_extract_all(body, '[!?]')) AS n_marks,
         len(regexp_extract_all(body, '\\p{{Lu}}')) AS n_capitals
  FROM texts t LEFT JOIN repeats p ON p.r = t.r),
based AS (SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATS_PCT} * n_words AS base_failed FROM counts),
marks AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT b.*, quality = 1 AS good FROM based b JOIN marks USING (doc_id) WHERE NOT base_failed),
sizes AS (SELECT stratum, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad FROM held GROUP BY stratum HAVING count(*) FILTER (good) > 0),
steps AS (
  SELECT h.stratum, i, count(*) FILTER (h.good AND out) AS k, count(*) FILTER (NOT h.good AND out) AS b
  FROM (SELECT *, coalesce({" OR ".join(f"coalesce({x}, false)" for x in _sql_failed("i").values())}, false) AS out
        FROM held, range(1, {STEPS + 1}) s(i)) h GROUP BY h.stratum, i),
tails AS (
  SELECT stratum, i, k, b, good, bad,
    list_sum(list_transform(range(0, k + 1), lambda x: exp(lgamma(good + 1) - lgamma(x + 1) - lgamma(good - x + 1)
      + x * ln({RISK}) + (good - x) * ln(1 - {RISK})))) AS tail
  FROM steps JOIN sizes USING (stratum)),
safe AS (
  SELECT * FROM tails WHERE k < good * {RISK} AND b > 0 AND tail <= {ERROR} / (SELECT count(*) FROM sizes)
    AND b / bad::DOUBLE - k / good::DOUBLE > 0),
picked AS (
  SELECT stratum, i AS step FROM safe
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY b / bad::DOUBLE - k / good::DOUBLE DESC, i) = 1),
judged AS (
  SELECT b.*, list_filter([{", ".join(f"CASE WHEN {x} THEN '{rule}' END" for rule, x in _sql_failed("step").items())}],
                          lambda x: x IS NOT NULL) AS failed
  FROM based b LEFT JOIN picked USING (stratum))
SELECT doc_id, {", ".join(f"{c}::BIGINT AS {c}" for c in COUNTS)}, base_failed, NOT base_failed AND len(failed) = 0 AS kept,
       array_to_string(failed, ',') AS failed_rules
FROM judged
"""
