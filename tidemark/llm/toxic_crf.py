"""Toxicity by a linear-chain conditional random field.

The chain runs over the words of a text with two states, clean and toxic. Labels
are of documents, so token labels are derived first: a word, or a prefix of it,
marks toxicity if its distinct contexts (the words before and after; copies of a
text give the same contexts and so count once) stand in toxic texts significantly
more often than in clean ones. The field is trained on windows that tile the whole
of every sampled text; word features are dropped at random, so that prefixes carry over to
forms not seen. Forward-backward gives every word its marginal; runs of words
above 1/2 are the offending spans, and a logistic model over the largest marginal
and the number of such words gives the document's score.

Training reads a bounded sample: MOST_LABELLED ids of each label, picked by hash, and
of these, in the same order, as many as hold MOST_WORDS words together; a longer text
is never among them, and of several texts of an id one is. Scoring reads every whole
text, in blocks of a chain product.

Edge cases: null and empty texts have no word and the score of a text without
any sign. Very long texts are one chain, scored whole. Labels that are null are not used; of repeated label rows the largest
counts. With no toxic or no clean label, every score is 0. Repeated rows each get
a row; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, lean, table, text_bytes, word_count
from tidemark.sources.ship import ship

#: Labelled rows of each label, and words of these, that training reads at most.
MOST_LABELLED, MOST_WORDS = 2000, 2_000_000
FEATURES = 1 << 18
PREFIXES, SUFFIX = (3, 4, 5, 6), 3
#: Log-likelihood that a mark needs, and the share of its contexts in toxic texts.
LEAST_SIGNIFICANCE, LEAST_PRECISION = 12.0, 0.97
REACH, EPOCHS, RATE, DECAY = 8, 12, 0.3, 1e-6
KEPT_WORDS = 300_000
BLOCK_TOKENS = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_EDGES = re.compile(r"^\W+|\W+$")


def plain(word: bytes) -> str:
    """Lower-cased, without marks at its edges."""
    return _EDGES.sub("", word.decode("utf-8", "replace").lower())


def names(word: str) -> list[str]:
    """Features of a word; the word itself comes first."""
    return [f"w {word}", *(f"p {word[:n]}" for n in PREFIXES if len(word) > n), f"s {word[-SUFFIX:]}"]


def slots(word: str) -> list[int]:
    return [xxhash.xxh32_intdigest(n) % FEATURES for n in names(word)]


@dataclass
class Sample:
    """Labelled texts as numbers of words: vocabulary, the numbers of all words, where each text ends, labels."""

    vocabulary: list[str]
    flat: np.ndarray
    ends: np.ndarray
    toxic: np.ndarray

    @classmethod
    def of(cls, texts: list[list[str]], toxic: list[bool]) -> Sample:
        ids: dict[str, int] = {"": 0}
        flat = np.fromiter((ids.setdefault(w, len(ids)) for words in texts for w in words), np.int32)
        return cls(list(ids), flat, np.cumsum([len(t) for t in texts], dtype=np.int64), np.array(toxic, bool))

    @property
    def starts(self) -> np.ndarray:
        return np.append(0, self.ends[:-1])

    def token_labels(self) -> np.ndarray:
        return np.repeat(self.toxic, self.ends - self.starts)


def marks(sample: Sample) -> np.ndarray:
    """For each word of the vocabulary, whether it marks toxicity itself or by a prefix."""
    word = sample.flat
    # before and after a text's edge stands the number of the empty word
    before, after = np.append(0, word[:-1]).astype(np.uint64), np.append(word[1:], 0).astype(np.uint64)
    some = sample.ends > sample.starts
    before[sample.starts[some]], after[sample.ends[some] - 1] = 0, 0
    context = ((_ODD * before + after) * _ODD) >> np.uint64(32)
    full = word > 0
    context, label, word = context[full], sample.token_labels()[full], word[full]
    share = (label.sum() + 1) / (len(label) + 2)
    marking = np.zeros(len(sample.vocabulary), bool)
    for kind in (None, *PREFIXES):
        group: dict[str, int] = {}
        of_word = np.array([group.setdefault(w if kind is None else w[:kind] if len(w) >= kind else "", len(group)) for w in sample.vocabulary])
        pair = of_word[word].astype(np.uint64) << np.uint64(32) | context
        n0, n1 = (np.bincount((np.unique(pair[label == k]) >> np.uint64(32)).astype(np.int64), minlength=len(group)) for k in (False, True))
        n = np.maximum(n0 + n1, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(n1, n1 * np.log(n1 / (n * share)), 0) + np.where(n0, n0 * np.log(n0 / (n * (1 - share))), 0)
        good = (n1 >= LEAST_PRECISION * n) & (n1 > 0) & (gain >= LEAST_SIGNIFICANCE)
        good[of_word[0]] = False
        marking |= good[of_word]
    marking[0] = False
    return marking


@dataclass
class Crf:
    """weights: of the features for the toxic state against the clean one; trans:
    log potentials (from, to); start: of the first word's toxic state."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray
    start: float
    #: of the document's score: logit of the largest marginal, log of one more than the words above 1/2, constant
    score: np.ndarray

    def emission(self, word: str) -> float:
        return float(self.weights[slots(word)].sum()) + self.bias if word else self.bias

    def marginals(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """P(toxic) of every word; first: marks the words where a text begins. All
        texts are one chain: where one begins, the transition forgets its origin.
        The chain is cut into segments whose matrices are multiplied side by side."""
        n = len(emissions)
        if not n:
            return np.zeros(0)
        length = max(1, int(n**0.5))
        count = -(-n // length)
        psi = np.exp(np.clip(emissions, -30, 30))
        m = np.empty((count * length, 2, 2))
        m[:] = np.eye(2)
        t = np.exp(self.trans)
        m[:n, :, 0], m[:n, :, 1] = t[:, 0], t[:, 1] * psi[:, None]
        m[:n][first, :, 0] = 1
        m[:n][first, :, 1] = (np.exp(self.start) * psi[first])[:, None]
        m /= m.sum(axis=(1, 2), keepdims=True)
        m = m.reshape(count, length, 2, 2)
        whole = m[:, 0].copy()
        for i in range(1, length):
            whole = whole @ m[:, i]
            whole /= whole.sum(axis=(1, 2), keepdims=True)
        ahead, behind = np.empty((count, 2)), np.empty((count, 2))
        a, b = np.array([0.5, 0.5]), np.array([0.5, 0.5])
        for k in range(count):
            ahead[k] = a
            a = a @ whole[k]
            a /= a.sum()
        for k in range(count - 1, -1, -1):
            behind[k] = b
            b = whole[k] @ b
            b /= b.sum()
        forward = np.empty((length, count, 2))
        for i in range(length):
            ahead = (ahead[:, None] @ m[:, i])[:, 0]
            ahead /= ahead.sum(1, keepdims=True)
            forward[i] = ahead
        out = np.empty((count, length))
        for i in range(length - 1, -1, -1):
            both = forward[i] * behind
            out[:, i] = both[:, 1] / both.sum(1)
            behind = (m[:, i] @ behind[:, :, None])[:, :, 0]
            behind /= behind.sum(1, keepdims=True)
        return out.ravel()[:n]

    def rate(self, largest: np.ndarray, above: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(signs(largest, above) @ self.score, -30, 30)))


def signs(largest: np.ndarray, above: np.ndarray) -> np.ndarray:
    p = np.clip(largest, 1e-6, 1 - 1e-6)
    return np.stack([np.log(p / (1 - p)), np.log1p(above), np.ones(len(p))], axis=1)


def train_crf(texts: list[list[str]], toxic: list[bool], rates: tuple[float, float] = (1.0, 1.0), seed: int = 3) -> Crf | None:
    """rates: how many rows each training row of either label stands for."""
    if all(toxic) or not any(toxic):
        return None
    random, sample = np.random.Generator(np.random.PCG64(seed)), Sample.of(texts, toxic)
    hit = sample.token_labels() & marks(sample)[sample.flat]
    # windows that tile every text
    span, counts = 2 * REACH + 1, sample.ends - sample.starts
    pieces = -(-counts // span)
    starts = np.repeat(sample.starts, pieces) + span * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    lengths = np.minimum(span, np.repeat(sample.ends, pieces) - starts)
    table = np.full((len(sample.vocabulary), 2 + len(PREFIXES)), FEATURES, np.int32)
    for i, w in enumerate(sample.vocabulary):
        if w:
            own = slots(w)
            table[i, : len(own)] = own
    crf = Crf(np.zeros(FEATURES), -2.0, np.zeros((2, 2)), 0.0, np.zeros(3))
    _fit(crf, sample, table, hit, starts, lengths, random)
    emissions = np.append(crf.weights, 0.0)[table].sum(1) + crf.bias
    largest, above = np.zeros(len(texts)), np.zeros(len(texts))
    for i, (start, end) in enumerate(zip(sample.starts.tolist(), sample.ends.tolist(), strict=True)):
        if end > start:
            p = crf.marginals(emissions[sample.flat[start:end]], np.arange(end - start) == 0)
            largest[i], above[i] = p.max(), (p > 0.5).sum()
    x, y, w = signs(largest, above), np.array(toxic, float), np.where(toxic, rates[1], rates[0])
    w = w / w.mean()
    for _ in range(50):  # Newton's steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ crf.score, -30, 30)))
        g = x.T @ (w * (p - y)) + crf.score
        h = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(3)
        crf.score = crf.score - np.clip(np.linalg.solve(h, g), -2, 2)
    return crf


def _fit(crf: Crf, sample: Sample, table: np.ndarray, hit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, random: np.random.Generator) -> None:
    """Adagrad on the conditional log-likelihood of the windows' states. table: the features of
    each word, hit: the state of each word of the sample, starts and lengths: the windows."""
    width, n, per = 2 * REACH + 1, len(starts), table.shape[1]
    weights = np.zeros(FEATURES + 1)  # the last one stays 0
    squares, other, other_sq = np.full(FEATURES + 1, 1e-3), np.array([crf.bias, crf.start, 0, 0, 0, 0.0]), np.full(6, 1e-3)
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for at in range(0, n, 512):
            take = order[at : at + 512]
            k = np.arange(width) < lengths[take, None]
            at_word = np.minimum(starts[take, None] + np.arange(width), len(sample.flat) - 1)
            s, y = table[sample.flat[at_word]], (hit[at_word] & k).astype(np.int64)
            s[~k] = FEATURES
            s[:, :, 0] = np.where(random.random(s.shape[:2]) < 0.5, FEATURES, s[:, :, 0])
            e = weights[s].sum(2) + other[0]
            t = other[2:].reshape(2, 2)
            node = np.zeros((len(take), width, 2))
            node[:, :, 1] = np.where(k, e, 0)
            alpha, beta = np.zeros_like(node), np.zeros_like(node)
            alpha[:, 0] = node[:, 0] + np.array([0, other[1]])
            for j in range(1, width):
                step = np.logaddexp(alpha[:, j - 1, :1] + t[0], alpha[:, j - 1, 1:] + t[1]) + node[:, j]
                alpha[:, j] = np.where(k[:, j, None], step, alpha[:, j - 1])
            for j in range(width - 2, -1, -1):
                after = node[:, j + 1] + beta[:, j + 1]
                step = np.logaddexp(t[:, 0] + after[:, :1], t[:, 1] + after[:, 1:])
                beta[:, j] = np.where(k[:, j + 1, None], step, beta[:, j + 1])
            z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
            p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])
            d = np.where(k, p - y, 0)
            g = np.bincount(s.ravel(), np.repeat(d.ravel(), per), FEATURES + 1) + DECAY * weights
            go = np.zeros(6)
            go[0], go[1] = d.sum(), (p[:, 0] - y[:, 0]).sum()
            both = k[:, 1:]
            for a in (0, 1):
                for b in (0, 1):
                    pair = np.exp(alpha[:, :-1, a] + t[a, b] + node[:, 1:, b] + beta[:, 1:, b] - z[:, None, None][:, 0])
                    go[2 + 2 * a + b] = (np.where(both, pair - ((y[:, :-1] == a) & (y[:, 1:] == b)), 0)).sum()
            g[FEATURES] = 0
            squares += g * g
            weights -= RATE * g / np.sqrt(squares)
            other_sq += go * go
            other -= RATE * go / np.sqrt(other_sq)
    crf.weights, crf.bias, crf.start, crf.trans = weights[:FEATURES], float(other[0]), float(other[1]), other[2:].reshape(2, 2)


def read_sample(docs: DataFrame, labels: DataFrame, in_training: Column, most: int = MOST_LABELLED, most_words: int = MOST_WORDS) -> tuple[DataFrame, dict[bool, int]]:
    """label_id, toxic, text of at most ``most`` rows and ``most_words`` words of each label (fixed
    bounds), and how many labelled ids there are of each label."""
    own = labels.where(in_training & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("label_id")).agg((F.max("toxic") == 1).alias("toxic"))
    sizes = {r.toxic: r.n for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = lambda: (F.xxhash64("label_id"), F.col("label_id"))
    picked = [own.where(F.col("toxic") == F.lit(t)).orderBy(*place()).limit(most) for t in (False, True)]
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    # the words of a text are counted where it is in the sample, and nowhere else
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), F.coalesce("text", F.lit("")).alias("text")).join(ids, "label_id")
    # one text an id: at most two times ``most`` rows go on
    one = texts.withColumn("n", word_count()).groupBy("label_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "n")).alias("t"))
    one = one.select("label_id", "toxic", F.col("t.text").cast("binary").alias("text"), "t.n").where(F.col("n") <= most_words)
    upto = F.sum("n").over(Window.partitionBy("toxic").orderBy(*place()).rowsBetween(Window.unboundedPreceding, 0))
    return one.withColumn("upto", upto).where(F.col("upto") <= most_words).select("label_id", "toxic", "text"), sizes


def score_documents(docs: DataFrame, crf: Crf | None, key: Column | None = None) -> DataFrame:
    """doc_id, score, n_toxic_words, spans (start, end: places of code points) of every row of docs (doc_id, text),
    and ``key``, a string, if it is given."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(crf)
    fields = ["doc_id", "score", "n_toxic_words", "spans"] + ["key"] * (key is not None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), *([] if key is None else [key.alias("key")]))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            largest, above, spans = np.zeros(len(texts)), np.zeros(len(texts), np.int64), [[] for _ in texts]
            low = 0
            while own and low < len(texts):
                high, size = low, 0
                parts = []
                while high < len(texts) and (high == low or size < BLOCK_TOKENS):
                    words = texts[high].split()
                    for w in {x for x in words if x not in known}:
                        if len(known) > KEPT_WORDS:
                            known.clear()
                        known[w] = own.emission(plain(w))
                    parts.append(np.fromiter((known[w] if w in known else own.emission(plain(w)) for w in words), float, len(words)))
                    size += len(words)
                    high += 1
                counts = np.array([len(p) for p in parts])
                starts = np.cumsum(counts) - counts
                first = np.zeros(size, bool)
                first[starts[counts > 0]] = True
                p = own.marginals(np.concatenate(parts), first)
                if size:
                    filled = np.flatnonzero(counts)
                    largest[low + filled] = np.maximum.reduceat(p, starts[filled])
                    above[low + filled] = np.add.reduceat((p > 0.5).astype(np.int64), starts[filled])
                for i in np.flatnonzero(above[low:high]).tolist():
                    spans[low + i] = places(texts[low + i], p[starts[i] : starts[i] + counts[i]] > 0.5)
                low = high
            score = own.rate(largest, above) if own else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(above), pa.array(spans, span_type), *batch.columns[2:]], fields)

    return rows.mapInArrow(lean(run), "doc_id long, score double, n_toxic_words long, spans array<struct<start: long, end: long>>" + ", key string" * (key is not None))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def places(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as places of code points."""
    out: list[dict[str, int]] = []
    last, chars, at = -2, 0, 0
    for i, m in enumerate(_WORD.finditer(text)):
        if hit[i]:
            chars += len(text[at : m.start()].decode("utf-8", "replace"))
            end = chars + len(m.group().decode("utf-8", "replace"))
            if last == i - 1 and out:
                out[-1]["end"] = end
            else:
                out.append({"start": chars, "end": end})
            chars, at, last = end, m.end(), i
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Crf | None:
    """Learns from the rows whose crc32(doc_id as text) mod 5 is not 0. The bounded sample is
    learnt from in one task; the driver gets the field alone."""
    ship(docs.sparkSession)
    rows, sizes = read_sample(docs, labels, crc_mod("doc_id", 5) != 0)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, str] = {}  # one string for each distinct word
        texts, toxic = [], []
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                toxic.append(label)
                texts.append([known[w] if w in known else known.setdefault(w, plain(w)) for w in text.split()])
        crf = train_crf(texts, toxic, tuple(sizes.get(t, 0) / max(1, toxic.count(t)) for t in (False, True))) if texts else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(crf)], pa.binary())], ["field"])

    # sorted by id, so that reruns learn in one order
    found = rows.repartition(1).sortWithinPartitions("label_id").select("toxic", "text").mapInArrow(lean(train), "field binary").collect()
    return pickle.loads(found[0].field) if found else None


def op5_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic_words", "spans")
