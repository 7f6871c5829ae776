"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

For a pre-token, let ``last(p)`` be the last token of the encoding of its prefix
p. The encoding of p is the encoding of p without that token, then the token;
and the token is the one suffix t of p for which the pair (last(p - t), t) is
left alone by the merges. So a prefix needs only the states of shorter prefixes,
and these are shared by all words that begin alike: the distinct new words of a
batch go into a trie, and a depth-first walk gives each node its state once. The
trie is held as its words in depth-first order, that is sorted: the nodes that a
word shares with the one before are their common prefix. So the walk holds the
states on one path alone, 4 bytes for each byte of a very long pre-token.

Texts are cut at the added tokens, then into pre-tokens by the library's own
pattern. Encodings of distinct pre-tokens are kept in a bounded table.

Edge cases: null counts as empty text, without tokens. Texts are read whole, very
long ones and long pre-tokens too; of merges of one rank the leftmost goes first;
repeated rows each get a row; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, worker_cache
from tidemark.sources.ship import ship

TOKENIZER = "byte_bpe_50k.json"
#: The published pattern of this kind of pre-tokenizer (a fixed value), with white space spelled out as the Unicode property.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Pre-tokens and pairs that a Python worker keeps; longer pre-tokens are not kept.
KEPT, KEPT_PAIRS, KEPT_LENGTH = 1_000_000, 800_000, 48
#: Beyond so many bytes the states of a path are held in 4 bytes each.
LONG_PATH = 1 << 16


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes: printable Latin-1 stands for itself, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """The tables of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._at_added = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self.bytes_of: dict[int, bytes] = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.longest = max(map(len, self.id_of))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self._pairs: dict[tuple[int, int], bool] = {}
        self._pattern = regex.compile(PATTERN)
        #: a token that its own merges do not make can't end an encoding
        self.suffix_ids = {b: i for b, i in self.id_of.items() if self.merge(b) == [i]}
        size = max(self.bytes_of) + 1
        self.text_table = [str(i) for i in range(size)]
        self.byte_table = [self.bytes_of.get(i, b"") for i in range(size)]
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain merging in rank order; used on tokens and pairs of tokens only."""
        ids = [self.id_of[word[i : i + 1]] for i in range(len(word))]
        while len(ids) > 1:
            rank, new, at = min(((*self.merges.get(p, (1 << 60, -1)), i) for i, p in enumerate(zip(ids, ids[1:], strict=False))), key=lambda x: (x[0], x[2]))
            if new < 0:
                break
            ids[at : at + 2] = [new]
        return ids

    def stands(self, a: int, b: int) -> bool:
        """Whether the merges leave the two tokens beside each other."""
        found = self._pairs.get((a, b))
        if found is None:
            if len(self._pairs) > KEPT_PAIRS:
                self._pairs.clear()
            found = self._pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def walk(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Encodings of distinct words through one trie, depth first."""
        out: dict[bytes, list[int]] = {}
        words = sorted(words)
        # last[d]: last token of the prefix of length d, on the path to the current node
        last = array("i", [-1]) if max(map(len, words), default=0) > LONG_PATH else [-1]
        token_of, pair, stands, longest, bytes_of = self.suffix_ids.get, self._pairs.get, self.stands, self.longest, self.bytes_of
        before = b""
        for word in words:
            depth, most = 0, min(len(before), len(word))
            if word[:most] == before[:most]:
                depth = most
            else:
                while word[depth] == before[depth]:
                    depth += 1
            before = word
            del last[depth + 1 :]
            for depth in range(depth + 1, len(word) + 1):
                for start in range(max(0, depth - longest), depth):
                    token = token_of(word[start:depth])
                    if token is not None:
                        if start:
                            fits = pair((last[start], token))
                            if not (stands(last[start], token) if fits is None else fits):
                                continue
                        last.append(token)
                        break
            ids, depth = [], len(word)
            while depth:
                token = last[depth]
                ids.append(token)
                depth -= len(bytes_of[token])
            ids.reverse()
            out[word] = ids
        return out

    def pre_tokens(self, text: str) -> list[str | int]:
        """Pre-tokens in order; an added token stands as its id."""
        if not any(t in text for t in self.added):
            return self._pattern.findall(text)
        out: list[str | int] = []
        at = 0
        for m in self._at_added.finditer(text):
            out += self._pattern.findall(text[at : m.start()])
            out.append(self.added[m.group()])
            at = m.end()
        return out + self._pattern.findall(text[at:])

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids (4 bytes each) of the words that aren't kept yet, through the trie; the long ones come back alone."""
        new = {w for w in words if w not in self.known}
        if len(self.known) + len(new) > KEPT:
            self.known.clear()
            new = words
        coded = {w.encode("utf-8", "replace"): w for w in new}
        long: dict[str, bytes] = {}
        for word, ids in self.walk(list(coded)).items():
            text = coded[word]
            (self.known if len(text) <= KEPT_LENGTH else long)[text] = np.array(ids, "<u4").tobytes()
        return long

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for i in range(0, len(texts), 256):
            cut = [self.pre_tokens(t) for t in texts[i : i + 256]]
            words = set().union(*cut)
            ids = {w for w in words if isinstance(w, int)}
            long = self.learn(words - ids) | {x: np.array([x], "<u4").tobytes() for x in ids}
            known = self.known
            known.update(long)
            coded = [b"".join(map(known.__getitem__, pre)) for pre in cut]
            for word in long:
                del known[word]
            for x in coded:
                yield np.frombuffer(x, "<u4")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.byte_table.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = worker_cache()


def bpe(path: str) -> Bpe:
    """One instance for each Python worker."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Bpe(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids of every row of docs (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for batch in batches:
            ids = pa.array([x.astype(np.int32) for x in own.encode(batch.column(1).to_pylist())], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def digest_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(tokenizer)
        for batch in batches:
            n, shas, back = [], [], []
            for ids in own.encode(batch.column(1).to_pylist()):
                listed = ids.tolist()
                n.append(len(listed))
                shas.append(hashlib.sha256(",".join(map(own.text_table.__getitem__, listed)).encode()).hexdigest())
                back.append(hashlib.sha256(own.decode(listed).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
