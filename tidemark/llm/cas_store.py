"""Token-id output as a content-addressed store.

Every text is encoded by the tokenizers library and ends with an end id. A
rolling hash over the last 16 ids cuts the stream of a document into chunks, so
equal passages give equal chunks wherever they stand. The store is a folder of
three Parquet tables:

``chunks``    hash, payload, uses: each distinct chunk once. hash is the SHA-256 of
              the ids as little-endian unsigned 32-bit integers; payload holds
              them in 2 bytes each where all fit, else in 4 (``width``); uses
              counts the places where it stands.
``recipes``   doc_id, range, inside, n_tokens, hashes, root: documents in ascending
              doc_id order, a range of them in each file; inside counts the ids
              before the document in its range; root is the Merkle root of the
              chunk hashes.
``manifest``  one row for each range: start (the ids of all ranges before), ids,
              documents, and the Merkle root over the roots of its documents.

Reading verifies every chunk against its hash, every document's root, and the
recipes against the manifest.

The library is called on words between blanks, once for each distinct word in a
batch, and its answers are kept in bounded tables; this tokenizer's normaliser
and pre-tokenizer drop white space, so joining the answers gives what the whole
text gives.

Edge cases: null counts as empty text and holds the end id alone. Rows with one
doc_id are documents of their own, in an order fixed by their content; null ids
come first. A very long text is one recipe of many chunks; its ids are held at once.
An empty table gives an empty store; other columns are not looked at.
"""

from __future__ import annotations

import gc
import hashlib
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import discard, join_hot, shared_path, staged, table, text_bytes
from tidemark.llm.trie_bpe import byte_alphabet
from tidemark.sources.ship import ship

# a task has one core; the library's own threads would only wait for each other
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
ROLL = 16
#: A cut falls at every 256th position on average, between these lengths.
CUT_MASK, SHORTEST, LONGEST = 255, 64, 2048
#: Distinct words whose ids a Python worker keeps, in two tables; longer words are not kept.
KEPT_WORDS, KEPT_LENGTH = 1_200_000, 40

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class WordIds(dict):
    """Word bytes to ids (4 bytes each), filled through the library. When half of what is
    kept is reached, the words go to a second table, from which those met again come back."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        # a word comes to the model once, and a cache of its own would only be filled
        self._library.model._resize_cache(0)
        vocab = self._library.get_vocab(with_added_tokens=True)
        self._before: dict[bytes, bytes] = {}
        self._closes = np.zeros(max(vocab.values()) + 1, bool)
        self._closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of the words that aren't kept yet; the long ones come back alone."""
        # the model's answers hold no cycles, and so many of them would set off one collection after the other
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._learn(words)
        finally:
            if collects:
                gc.enable()

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        new = [w for w in words if w not in self]
        if len(self) + len(new) > KEPT_WORDS // 2:
            self._before = self.copy()
            self.clear()
            new = words
        before = self._before
        if before:
            again = [w for w in new if w in before]
            self.update(zip(again, map(before.__getitem__, again), strict=True))
            new = [w for w in new if w not in before]
        long: dict[bytes, bytes] = {}
        # a word of lower-case Latin letters is one pre-token that the normaliser leaves as
        # it is: the library's model gets its bytes at once, of which a to z stand for themselves
        ascii_words = [w for w in new if w.isalpha() and w.islower()]
        done = set(ascii_words)
        texts = {w: w.decode("utf-8", "replace") for w in new if w not in done}
        latin = [w for w, t in texts.items() if t.isalpha() and t.islower() and max(t) < LATIN_END]
        direct, tokenize = ascii_words + latin, self._library.model.tokenize
        forms = [w.decode() for w in ascii_words] + [w.decode("latin-1").translate(_STAND_INS) for w in latin]
        for i in range(0, len(direct), 1024):
            got = list(map(tokenize, forms[i : i + 1024]))
            data, start = array("I", [t.id for word in got for t in word]).tobytes(), 0
            for word, tokens in zip(direct[i : i + 1024], got, strict=True):
                end = start + 4 * len(tokens)
                (self if len(word) <= KEPT_LENGTH else long)[word] = data[start:end]
                start = end
        for word in latin:
            del texts[word]
        # other words of letters are one pre-token too, and the last token of each carries the
        # end mark: many such words are encoded as one text and told apart by it
        plain, rest = [], []
        for w, text in texts.items():
            (plain if text.isalpha() else rest).append(w)
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for group, got in zip(groups, self._encode([" ".join([texts[w] for w in g]) for g in groups]), strict=True):
            ids = np.array(got, "<u4")
            ends = np.flatnonzero(self._closes[ids]) + 1
            if len(ends) != len(group) or ends[-1] != len(ids):
                rest += group
                continue
            data, start = ids.tobytes(), 0
            for word, end in zip(group, (4 * ends).tolist(), strict=True):
                (self if len(word) <= KEPT_LENGTH else long)[word] = data[start:end]
                start = end
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            for word, got in zip(part, self._encode([texts[w] for w in part]), strict=True):
                (self if len(word) <= KEPT_LENGTH else long)[word] = array("I", got).tobytes()
        return long

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]


#: Lower-case letters before this one are their own composed and lower-case form.
LATIN_END = "\u0180"
#: The byte alphabet's stand-in of each byte.
_STAND_INS = {b: c for c, b in byte_alphabet().items()}
_words: dict[str, WordIds] = {}


GROUP = 256
#: Kinds of bytes: a to z, marks that end words, blanks, bytes that continue a character.
_LETTER, _MARK, _SPACE, _MORE = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = _LETTER
_KIND[np.frombuffer(b".,;:!?*$%&#", np.uint8)] = _MARK
_KIND[np.frombuffer(b" \t\n", np.uint8)] = _SPACE
_KIND[0x80:0xC0] = _MORE
#: Marks in a row that are looked at.
LONGEST_RUN = 8


def loosened(texts: list[bytes]) -> list[bytes]:
    """The texts with A-Z lower-cased and a blank between a Latin letter and the marks that end
    its word: the tokenizer does the first and cuts there by itself, and fewer distinct words
    are left. Texts that may hold an added token stay as they are, and so do those with
    bytes of U+0300 to U+037F: the tokenizer composes such marks with the letter before
    it lower-cases, and some letters compose in one case alone."""
    out = list(texts)
    plain = [i for i, t in enumerate(texts) if b"<|" not in t and b"\xcc" not in t and b"\xcd" not in t]
    joined = np.frombuffer(b"\n".join([texts[i] for i in plain]).lower() + b"\n", np.uint8)
    kind = _KIND[joined]
    is_mark = kind == _MARK
    runs = np.flatnonzero(is_mark[1:] & ~is_mark[:-1]) + 1
    before, lead = joined[runs - 1], joined[np.maximum(runs - 2, 0)]
    # U+00C0 to U+017F are letters but for the signs of multiplication and division
    latin = (kind[runs - 1] == _MORE) & ((lead == 0xC4) | (lead == 0xC5) | ((lead == 0xC3) & (before != 0x97) & (before != 0xB7)))
    runs = runs[latin | (kind[runs - 1] == _LETTER)]
    after = runs + 1
    for _ in range(LONGEST_RUN):
        after += is_mark[after]
    marks = runs[kind[after] == _SPACE]
    whole = np.insert(joined, marks, 32).tobytes()
    ends = np.cumsum([len(texts[i]) + 1 for i in plain])
    ends = (ends + np.searchsorted(marks, ends)).tolist()
    for i, start, end in zip(plain, [0, *ends], ends, strict=False):
        out[i] = whole[start : end - 1]
    return out


def encode_texts(texts: list[bytes], path: str, end: bytes = b"") -> Iterator[tuple[bytes, list[int]]]:
    """For each GROUP of texts: the ids, 4 bytes each and ``end`` after each text, and where each text ends."""
    if path not in _words:
        _words.clear()
        _words[path] = WordIds(path)
    known = _words[path]
    for i in range(0, len(texts), GROUP):
        words, places, text_ends = distinct_words(loosened(texts[i : i + GROUP]))
        long = known.learn(words)
        coded = [known[w] if w in known else long[w] for w in words] + [end]
        places = np.insert(places, text_ends, len(words))
        sizes = np.array(list(map(len, coded)), np.int64) // 4
        first, counts = (np.cumsum(sizes) - sizes)[places], sizes[places]
        ends = np.cumsum(counts)
        pool = np.frombuffer(b"".join(coded), "<u4")
        ids = pool[np.repeat(first - ends + counts, counts) + np.arange(counts.sum())]
        yield ids.tobytes(), ends[text_ends + np.arange(len(text_ends))].tolist()


#: A word of so many bytes, and its length, are told from others by three numbers.
SHORT_WORD = 16
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: The first bytes of eight, by how many.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def distinct_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of the texts, each of at most SHORT_WORD bytes hardly more than once; for all
    places in order the number of the word there; and how many places there are up to each text's end."""
    joined = b" ".join(texts) + b" " + bytes(SHORT_WORD)
    blank = _BLANK[np.frombuffer(joined, np.uint8, len(joined) - SHORT_WORD)]
    edges = np.diff(blank.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    text_ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    lengths = ends - starts
    eight = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
    low = eight[starts] & _FIRST[np.minimum(lengths, 8)]
    high = eight[starts + 8] & _FIRST[np.clip(lengths - 8, 0, 8)]
    # words with one hash stand together; where others come between, a word is only listed again
    mixed = (low ^ (low >> np.uint64(31))) * _MULTIPLIER + (high ^ (high >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + lengths.astype(np.uint64)
    order = np.argsort(mixed ^ (mixed >> np.uint64(32)))
    low, high, lengths = low[order], high[order], lengths[order]
    new = np.ones(len(order), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (lengths[1:] != lengths[:-1]) | (lengths[1:] > SHORT_WORD)
    places = np.empty(len(order), np.int64)
    places[order] = np.cumsum(new) - 1
    picked = order[new]
    return [joined[a:b] for a, b in zip(starts[picked].tolist(), ends[picked].tolist(), strict=True)], places, text_ends


def rolling(ids: np.ndarray) -> np.ndarray:
    """Hash of the ROLL ids that end at each position."""
    x = ids.astype(np.uint64) + np.uint64(1)
    x *= _MULTIPLIER
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    span, power = 1, _MULTIPLIER
    while span < ROLL and len(x) > span:
        x[span:] = x[span:] + power * x[:-span]
        span, power = 2 * span, np.uint64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
    return x >> np.uint64(32)


def cut_points(ids: np.ndarray, text_ends: list[int]) -> list[list[int]]:
    """Ends of the chunks of each text. No cut lies within SHORTEST, which is more
    than ROLL, of a text's start, so cuts depend on the text's own ids alone."""
    marks = (np.flatnonzero((rolling(ids) & np.uint64(CUT_MASK)) == 0) + 1).tolist()
    out, start, m = [], 0, 0
    for text_end in text_ends:
        ends: list[int] = []
        while m < len(marks) and marks[m] <= text_end:
            at = marks[m]
            m += 1
            while at - start > LONGEST:
                start += LONGEST
                ends.append(start)
            if at - start >= SHORTEST:
                start = at
                ends.append(start)
        while text_end - start > LONGEST:
            start += LONGEST
            ends.append(start)
        if start < text_end:
            ends.append(text_end)
        start = text_end
        out.append(ends)
    return out


class Merkle:
    """A Merkle root, built from the left. Pairs are hashed together; an odd last one goes up
    as it is. Holds one hash a level."""

    def __init__(self, hashes: Iterable[bytes] = ()) -> None:
        self._levels: list[bytes | None] = []
        for h in hashes:
            self.add(h)

    def add(self, h: bytes) -> None:
        for i, left in enumerate(self._levels):
            if left is None:
                self._levels[i] = h
                return
            self._levels[i] = None
            h = hashlib.sha256(left + h).digest()
        self._levels.append(h)

    def root(self) -> bytes:
        out = None
        for left in self._levels:
            if left is not None:
                out = left if out is None else hashlib.sha256(left + out).digest()
        return hashlib.sha256(b"").digest() if out is None else out


def merkle_root(hashes: list[bytes]) -> bytes:
    return hashes[0] if len(hashes) == 1 else Merkle(hashes).root()


def _pack(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def _unpack(payload: bytes, width: int) -> np.ndarray:
    return np.frombuffer(payload, "<u2" if width == 2 else "<u4").astype("<u4")


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes docs (doc_id, text) and writes the store to the folder ``path``."""
    spark = docs.sparkSession
    ship(spark)
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hashes, payloads, roots = [], [], [], []
            for data, text_ends in encode_texts(batch.column(1).to_pylist(), tokenizer, np.uint32(end_id).tobytes()):
                ids, start = np.frombuffer(data, "<u4"), 0
                packed = _pack(ids, width)
                for text_end, ends in zip(text_ends, cut_points(ids, text_ends), strict=True):
                    n.append(text_end - start)
                    own, parts = [], []
                    for end in ends:
                        own.append(hashlib.sha256(data[4 * start : 4 * end]).digest())
                        parts.append(packed[width * start : width * end])
                        start = end
                    hashes.append(own)
                    payloads.append(parts)
                    roots.append(merkle_root(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.list_(pa.binary())), pa.array(payloads, pa.list_(pa.binary())), pa.array(roots, pa.binary())], ["doc_id", "n_tokens", "hashes", "payloads", "root"])

    salt = F.xxhash64(F.monotonically_increasing_id())
    rows = docs.select("doc_id", text_bytes().alias("text")).mapInArrow(encode, "doc_id long, n_tokens long, hashes array<binary>, payloads array<binary>, root binary")
    encoded = staged(rows.withColumn("salt", salt), "cas-encoded")
    chunks = encoded.select(F.explode(F.arrays_zip("hashes", "payloads")).alias("c")).select(F.col("c.hashes").alias("hash"), F.col("c.payloads").alias("payload"))
    chunks.groupBy("hash").agg(F.first("payload").alias("payload"), F.count("*").alias("uses")).withColumn("width", F.lit(width)).write.option("compression", "zstd").parquet(f"{path}/chunks")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ahead = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            inside = ahead + np.cumsum(n) - n
            ahead += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(n), own, np.int32)), pa.array(inside), *batch.columns[1:]], ["doc_id", "range", "inside", "n_tokens", "hashes", "root"])

    # files and their rows in document order; the salt parts rows that are alike
    place = ["doc_id", "root", "salt"]
    dealt = encoded.select("doc_id", "n_tokens", "hashes", "root", "salt").repartitionByRange(*place).sortWithinPartitions(*place).drop("salt")
    dealt.mapInArrow(number, "doc_id long, range int, inside long, n_tokens long, hashes array<binary>, root binary").write.option("compression", "zstd").parquet(f"{path}/recipes")
    discard(encoded)

    found, start = [], 0
    for row in _manifest(spark.read.parquet(f"{path}/recipes")):
        found.append((row[0], start, *row[1:]))
        start += row[1]
    spark.createDataFrame(found, "range int, start long, n_tokens long, n_docs long, first_id long, root binary").write.parquet(f"{path}/manifest")


def _manifest(recipes: DataFrame) -> list[tuple]:
    """range, n_tokens, n_docs, first_id, root of each range, of which there are as many as
    files; raises where the places of documents don't follow from the ids before."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, own, at, n, first, roots = [], None, 0, 0, None, Merkle()
        for batch in batches:
            for number, inside, n_tokens, doc_id, root in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != own:
                    if own is not None:
                        out.append((own, at, n, first, roots.root()))
                    own, at, n, first, roots = number, 0, 0, doc_id, Merkle()
                if inside != at:
                    raise ValueError("a document's place differs from the ids before it")
                at, n = at + n_tokens, n + 1
                roots.add(root)
        if own is not None:
            out.append((own, at, n, first, roots.root()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["range", "n_tokens", "n_docs", "first_id", "root"])

    rows = recipes.select("range", "inside", "n_tokens", "doc_id", "root").repartition("range").sortWithinPartitions("range", "inside")
    return sorted((r[0], r[1], r[2], r[3], bytes(r[4])) for r in rows.mapInArrow(fold, "range int, n_tokens long, n_docs long, first_id long, root binary").collect())


def verify_manifest(spark: SparkSession, path: str) -> None:
    """Raises where the recipes aren't those that the manifest was made from."""
    want, start = [], 0
    for r in sorted(spark.read.parquet(f"{path}/manifest").collect()):
        want.append((r.range, r.n_tokens, r.n_docs, r.first_id, bytes(r.root)))
        if r.start != start:
            raise ValueError("the manifest's starts differ from its ids")
        start += r.n_tokens
    if _manifest(spark.read.parquet(f"{path}/recipes")) != want:
        raise ValueError("the recipes differ from the manifest")


def _product(a: int, b: int) -> int:
    """a * b modulo the CRC-32 polynomial, bits reflected."""
    m, p = 1 << 31, 0
    while m:
        if a & m:
            p ^= b
        m >>= 1
        b = (b >> 1) ^ 0xEDB88320 if b & 1 else b >> 1
    return p


_shifts: dict[int, int] = {}


def crc_join(first: int, second: int, second_bytes: int) -> int:
    """crc32 of two pieces from the crc32 of each."""
    if second_bytes not in _shifts:
        power, square, n = 1 << 31, 1 << 30, 8 * second_bytes  # x^0, x^1
        while n:
            if n & 1:
                power = _product(square, power)
            square, n = _product(square, square), n >> 1
        if len(_shifts) > 100_000:
            _shifts.clear()
        _shifts[second_bytes] = power
    return _product(_shifts[second_bytes], first) ^ second


def verified_chunks(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    """hash, uses, n, crc[, payload, width] of every chunk; raises where content and hash differ."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, crcs = [], []
            for own, payload, width in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                ids = _unpack(payload, width).tobytes()
                if hashlib.sha256(ids).digest() != own:
                    raise ValueError(f"chunk {own.hex()} is damaged")
                n.append(len(ids) // 4)
                crcs.append(zlib.crc32(ids))
            cols, names = [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(crcs, pa.int64()), *batch.columns[2:]], ["hash", "uses", "n", "crc", "payload", "width"]
            yield pa.RecordBatch.from_arrays(cols[: 6 if with_ids else 4], names[: 6 if with_ids else 4])

    return spark.read.parquet(f"{path}/chunks").select("hash", "uses", "payload", "width").mapInArrow(check, "hash binary, uses long, n long, crc long" + ", payload binary, width int" * with_ids)


def _assembled(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    """Each recipe with its chunks in order; no document loses or gains one."""
    verify_manifest(spark, path)
    starts = spark.read.parquet(f"{path}/manifest").select("range", F.col("start").alias("ahead"))  # a row a file
    recipes = spark.read.parquet(f"{path}/recipes").join(F.broadcast(starts), "range")
    parts = recipes.select("doc_id", (F.col("ahead") + F.col("inside")).alias("start"), "n_tokens", "root", F.posexplode("hashes").alias("pos", "hash"))
    fields = ["pos", "hash", "n", "crc"] + ["payload", "width"] * with_ids
    chunks = staged(verified_chunks(spark, path, with_ids), "cas-verified")
    joined = join_hot(parts, chunks, "hash", "uses", chunks.agg(F.coalesce(F.sum("uses"), F.lit(0))).first()[0])
    return joined.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.first("root").alias("root"), F.sort_array(F.collect_list(F.struct(*fields))).alias("parts"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.
    A document's checksum is joined from its chunks' checksums, so chunk contents
    are read once, where they lie, and only digests are shuffled."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for parts, n, root in zip(batch.column(4).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if any(p["crc"] is None for p in parts) or sum(p["n"] for p in parts) != n or merkle_root([p["hash"] for p in parts]) != root:
                    raise ValueError("a document can't be put together from its chunks")
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc_join(crc, p["crc"], 4 * p["n"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), batch.column(2), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _assembled(spark, path, False).mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every document, put together and verified."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for parts, n, root in zip(batch.column(4).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if any(p["payload"] is None for p in parts) or merkle_root([p["hash"] for p in parts]) != root:
                    raise ValueError("a document can't be put together from its chunks")
                ids.append(np.concatenate([_unpack(p["payload"], p["width"]) for p in parts]).astype(np.int64))
                if len(ids[-1]) != n:
                    raise ValueError("a document has lost ids")
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "start", "ids"])

    return _assembled(spark, path, True).mapInArrow(join, "doc_id long, start long, ids array<long>")


def op4_cas_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "cas-store")
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return read_digests(spark, path)
