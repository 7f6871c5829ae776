"""The corpus pipeline: five stages over the documents of a folder of tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns
of documents; what a stage rejects is gone for the next.

1. toxicity: documents that the random field predicts toxic go.
2. exact_dedup: of equal texts the row with the most code points, then the
   smallest id, stays.
3. ngram_jaccard: one document of each group of near duplicates stays, the one
   with the smallest id.
4. mix_sources: documents that the mix takes no word of go; a document that it
   takes twice stands there twice. Documents without words are kept once.
5. bpe: doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row left.

What a stage decides for a row goes for the rows with its id and its text (and, in
the mix, its source) alone: an id may stand beside several texts, and a null id is
an id like others. Of a group's rows with the smallest id, or with null ids alone,
the one with the least digest of the text stays.

Edge cases: null texts count as empty. Repeated rows, alike in id and text, are one
document for exact_dedup: of those with the most code points the one with the least
hash of all its columns stays. Very long texts are judged whole in every stage. Empty
tables give empty results, and without labels nothing is toxic. Extra columns of
documents are carried along, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import fair_mix, grace_dedup, sparse_jaccard, toxic_crf, trie_bpe
from tidemark.llm.common import staged, table

#: Names of the working columns; a name like these is not expected in documents.
_ID, _KEY = "__tidemark_id", "__tidemark_key"


def _row_key(*more: str) -> Column:
    """The id, the digest of the text and ``more`` columns; never null."""
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return F.concat_ws(":", F.col("doc_id").cast("long").cast("string"), sha, *more)


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of docs whose _row_key isn't in column _ID of ``rejected``."""
    return docs.withColumn(_KEY, _row_key()).join(rejected, F.col(_KEY) == F.col(_ID), "left_anti").drop(_KEY)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    crf = toxic_crf.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxic_crf.score_documents(docs, crf, _row_key()).where(F.col("score") >= 0.5).select(F.col("key").alias(_ID))
    return _without(docs, judged)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # an id may stand beside several texts, so the text is part of the key
    key = lambda sha: F.concat_ws(":", F.col("doc_id").cast("long").cast("string"), sha)
    sha = F.sha2(F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]", "").cast("binary"), 256)
    kept = grace_dedup.exact_groups(docs).where("kept").select(key(F.col("text_sha256")).alias(_KEY)).distinct()
    # of repeated rows one stays (rows with one id and text differ in other columns or blanks at most);
    # most of a hot one's rows go before the shuffle, and the join finds the rows where the window left them
    longest = F.row_number().over(fair_mix.Window.partitionBy(_ID).orderBy(F.length("text").desc_nulls_last(), F.xxhash64(*docs.columns)))
    first = docs.withColumn(_ID, key(sha)).withColumn(_ID + "_place", longest).where(F.col(_ID + "_place") == 1)
    return first.join(kept, F.col(_ID) == F.col(_KEY)).drop(_ID, _KEY, _ID + "_place")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = sparse_jaccard.jaccard_join(docs, _row_key()).where(~F.col("first")).select(F.col("key").alias(_ID))
    return _without(docs, rest)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = fair_mix.mix(docs, key=_row_key("source"))
    times = F.when(F.col("size") == 0, 1).otherwise((F.col("taken") / F.col("size")).cast("int"))
    taken = mixed.groupBy(F.col("key").alias(_ID)).agg(F.max(times).alias(_KEY)).where(F.col(_KEY) > 0)
    joined = docs.withColumn(_ID + "_row", _row_key("source")).join(taken, F.col(_ID + "_row") == F.col(_ID)).drop(_ID + "_row")
    return joined.withColumn(_KEY, F.explode(F.array_repeat(F.lit(1), F.col(_KEY)))).drop(_ID, _KEY)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return trie_bpe.digest_documents(docs, public_tokenizers.path(trie_bpe.TOKENIZER))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

#: The random field and the tokenizer are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
