"""Quality rules as a bitmask ledger, in DataFrame functions alone.

Every rule is evaluated once for each document; the ledger keeps the measures
and one bit for each failed rule. Policies are versioned masks over those bits:
applying one is a bitwise ``and``, and the ablation of a rule (what its policy
would keep without it) is a count over the distinct bit patterns.

Edge cases: null and empty texts have no words, so they fail ``few_words``;
texts are read whole; repeated rows each get a row; an empty table gives an
empty ledger; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_CLASS, table

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class QualityRule:
    """sql: a predicate over the measures, true where the document fails; the same
    text serves Spark and DuckDB."""

    name: str
    bit: int
    sql: str


QUALITY_RULES = (
    QualityRule("few_words", 0, "n_words < 50"),
    QualityRule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    QualityRule("many_symbols", 2, "10 * n_symbols > n_words"),
    QualityRule("repeated_lines", 3, "100 * n_dup_lines > 50 * n_lines"),
    QualityRule("short_or_long_words", 4, "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: r.bit for r in QUALITY_RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE_POLICY = Policy("base", ("few_words", "repeated_words"))
POLICIES = {p.version: p for p in (BASE_POLICY, Policy("2", tuple(r.name for r in QUALITY_RULES)))}
CURRENT = "2"


def _repeat_words(words: Column, grams: Column) -> Column:
    """Words inside three-word windows that occur twice or more. Sorting (hash,
    position) puts equal windows side by side: n log n for any text."""
    order = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

    def covered(s: Column) -> Column:
        # get() gives null beyond either end
        twice = lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))
        places = F.transform(F.filter(s, twice), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    # the one-element transform binds the sorted array, so that it is made once
    found = F.transform(F.array(order), covered)
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(F.get(found, F.lit(0)))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = docs.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD_CLASS), F.lit(0)).alias("words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words, lines = F.col("words"), F.col("lines")
    n = F.size(words)
    grams = F.when(n >= 3, F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    counted = worded.select(
        "doc_id", "n_symbols", "words",
        n.cast("long").alias("n_words"),
        F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        grams.alias("grams"),
    )
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        _repeat_words(F.col("words"), F.col("grams")).cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, rules: tuple[QualityRule, ...] = QUALITY_RULES) -> DataFrame:
    """The measures and ``fail_bits``: bit i is set where the rule of bit i fails."""
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.sql), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("fail_bits", bits)


def passes(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(ledger_df: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, that fail it alone, and
    that the policy keeps without it. Counts run over at most 2^rules patterns."""
    masked = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = ledger_df.groupBy(masked.alias("bits")).agg(F.count("*").alias("n"))
    own = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("own")) for r in QUALITY_RULES if r.name in policy.rules))).alias("r")
    rows = patterns.select("bits", "n", own).select("bits", "n", "r.rule", "r.own")
    hit = F.col("bits").bitwiseAND(F.col("own")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("own"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not("own")) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def op2_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed_base = ~passes(BASE_POLICY)
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed_base.alias("base_failed"), (~failed_base & passes(POLICIES[CURRENT])).alias("kept"), "n_lines", "fail_bits",
    )


OP2_SQL = f"""
with a as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
b as (select k, doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
             cast(len(regexp_extract_all(text, '{SYMBOLS}')) as bigint) as n_symbols,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from a),
g as (select k, unnest(range(1, len(words) - 1)) as p, words from b),
h as (select k, p, count(*) over (partition by k, words[p], words[p + 1], words[p + 2]) as n from g),
r as (select k, count(distinct q) as n_repeat_words from (select k, unnest([p, p + 1, p + 2]) as q from h where n > 1) group by k),
m as (select doc_id, cast(len(words) as bigint) as n_words,
             cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars, n_symbols,
             cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
             cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words from b left join r using (k)),
f as (select *, cast({" + ".join(f"case when {r.sql} then {1 << r.bit} else 0 end" for r in QUALITY_RULES)} as bigint) as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {BASE_POLICY.mask}) <> 0 as base_failed,
       (fail_bits & {POLICIES[CURRENT].mask | BASE_POLICY.mask}) = 0 as kept, n_lines, fail_bits
from f"""
