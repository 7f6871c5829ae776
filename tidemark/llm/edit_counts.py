"""Edit-aware token counting.

A document's pre-tokens are the leaves of a segment tree whose nodes hold sums
of characters and tokens. An edit finds the leaves it touches by descending on
characters, takes the few leaves before them along, because the pre-tokenizer's
pattern looks ahead, and re-cuts from there until a new boundary falls on an old
one behind the edit: from such a place on the old cuts hold. Only the pre-tokens
in between are encoded again, and only the paths above them are summed again.

Trees are kept: build_trees writes a row for each document, with its text and the
characters and tokens of each leaf, and edit_trees reads such rows, applies edits and
gives such rows again, without cutting or encoding what the edits leave alone.

The query builds the trees of all documents in the shared folder and applies one
production edit set to them: redaction of e-mail addresses, of long digit runs and
of key-like strings.

Edge cases: null counts as empty text with no tokens; overlapping matches of the
redaction rules are taken from left to right; texts are read whole, very long ones
too, with 8 bytes a pre-token; repeated rows each get a row; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import staged, table
from tidemark.llm.trie_bpe import KEPT, KEPT_LENGTH, PATTERN, TOKENIZER
from tidemark.sources.ship import ship

# a task has one core; the library's own threads would only wait for each other
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Leaves taken along before an edit: the pattern looks at most two characters beyond a match.
CONTEXT = 3
#: Characters re-cut at once behind an edit while looking for a common boundary.
STRETCH = 64
#: Pre-tokens that the library gets as one text.
GROUP = 256
REDACTIONS = (
    (r"[\w.+-]+@[\w-]+\.[\w.-]+", "<email>"),
    (r"\+?\d[\d ().-]{7,}\d", "<number>"),
    (r"\b[A-Za-z0-9_-]{24,}\b", "<key>"),
)

Edit = tuple[int, int, str]


class CountTree:
    """Segment tree over pre-tokens. A leaf that an edit has re-cut holds several
    pre-tokens, as one string; the leaves it swallowed hold none. Other leaves are
    stretches of the text."""

    def __init__(self, text: str, lengths: np.ndarray, counts: np.ndarray, cut: Callable[[str], list[str]], count: Callable[[list[str]], np.ndarray]) -> None:
        """lengths, counts: characters and tokens of each leaf."""
        self._text, self._cut, self._count = text, cut, count
        lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
        self.n_leaves = n = max(1, len(lengths))
        self._at = np.zeros(n + 1, np.int64)  # where each leaf of the text begins
        np.cumsum(lengths, out=self._at[1 : len(lengths) + 1])
        self._recut: dict[int, list[str]] = {}
        self.size = 1
        while self.size < n:
            self.size *= 2
        self.chars, self.tokens = np.zeros(2 * self.size, np.int64), np.zeros(2 * self.size, np.int64)
        for sums, own in ((self.chars, lengths), (self.tokens, counts)):
            sums[self.size : self.size + len(own)] = own
            width = self.size
            while width > 1:
                sums[width // 2 : width] = sums[width : 2 * width].reshape(-1, 2).sum(axis=1)
                width //= 2
        self.n_recut = 0

    @classmethod
    def of(cls, text: str, cut: Callable[[str], list[str]], count: Callable[[list[str]], np.ndarray]) -> CountTree:
        """The tree of a text that is new."""
        leaves = cut(text)
        return cls(text, np.fromiter(map(len, leaves), np.int64, len(leaves)), count(leaves), cut, count)

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    @property
    def length(self) -> int:
        return int(self.chars[1])

    def leaf(self, i: int) -> str:
        pieces = self._recut.get(i)
        return self._text[self._at[i] : self._at[i + 1]] if pieces is None else "".join(pieces)

    def text(self) -> str:
        out, at = [], 0
        for i in sorted(self._recut):
            out += [self._text[at : self._at[i]], *self._recut[i]]
            at = int(self._at[i + 1])
        return "".join([*out, self._text[at:]])

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of each leaf, a pre-token each: what a row keeps."""
        lengths, counts = [], []
        at = 0
        for i in sorted(self._recut):
            pieces = self._recut[i]
            lengths += [self.chars[self.size + at : self.size + i], np.array([len(x) for x in pieces], np.int64)]
            counts += [self.tokens[self.size + at : self.size + i], self._count(pieces)]
            at = i + 1
        end = self.size + self.n_leaves
        lengths, counts = np.concatenate([*lengths, self.chars[self.size + at : end]]), np.concatenate([*counts, self.tokens[self.size + at : end]])
        return lengths[lengths > 0], counts[lengths > 0]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where that leaf begins."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def _put(self, i: int, pieces: list[str]) -> None:
        self._recut[i] = pieces
        node = self.size + i
        self.chars[node] = sum(map(len, pieces))
        self.tokens[node] = int(self._count(pieces).sum()) if pieces else 0
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces characters start to end (excluded) by ``new``."""
        if not 0 <= start <= end <= self.length:
            raise IndexError((start, end, self.length))
        first, first_at = (0, 0) if not self.length else self._find(min(start, self.length - 1))
        taken = 0
        while first > 0 and taken < CONTEXT:
            first -= 1
            taken += len(self._recut[first]) if first in self._recut else 1
            first_at -= int(self.chars[self.size + first])
        # old text from first_at on, read leaf by leaf as far as it is needed
        old, stop = "", first
        while stop < self.n_leaves and first_at + len(old) < end + STRETCH:
            old += self.leaf(stop)
            stop += 1
        while True:
            whole = stop == self.n_leaves
            text = old[: start - first_at] + new + old[end - first_at :]
            shift = len(new) - (end - start)
            pieces = self._cut(text)
            # old boundaries at leaf ends behind the edit, as places in the new text
            ends, at = {}, first_at
            for i in range(first, stop):
                at += int(self.chars[self.size + i])
                if at >= end:
                    ends[at - first_at + shift] = i
            at, keep = 0, None
            for k, piece in enumerate(pieces):
                at += len(piece)
                # a cut near the end of what was read may still depend on what follows
                if at in ends and at >= start - first_at + len(new) and (whole or at + 2 * CONTEXT < len(text)):
                    keep = (k + 1, ends[at])
                    break
            if keep or whole:
                n, last = keep or (len(pieces), stop - 1)
                self._put(first, pieces[:n])
                self.n_recut += n
                for i in range(first + 1, last + 1):
                    if self.chars[self.size + i]:
                        self._put(i, [])
                return
            more = stop + max(8, stop - first)
            while stop < min(more, self.n_leaves):
                old += self.leaf(stop)
                stop += 1


class Counter:
    """Token counts of pre-tokens through the library, kept in a bounded table."""

    def __init__(self, path: str) -> None:
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        vocab = self._library.get_vocab(with_added_tokens=True)
        self._opens = np.zeros(max(vocab.values()) + 1, bool)
        self._opens[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self._known: dict[str, int] = {}
        self.cut = regex.compile(PATTERN).findall

    def __call__(self, pieces: list[str]) -> np.ndarray:
        known = self._known
        try:
            return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        except KeyError:
            new = [p for p in set(pieces) if p not in known]
        if len(known) + len(new) > KEPT:
            known.clear()
            new = list(set(pieces))
        known.update(self._encoded(new))
        out = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        for p in new:
            if len(p) > KEPT_LENGTH:
                del known[p]
        return out

    def _encoded(self, new: list[str]) -> dict[str, int]:
        # a blank and letters are one pre-token, and only its first token starts with
        # the blank: many such ones are encoded as one text and told apart by it
        plain = [p for p in new if p[0] == " " and p[1:].isalpha()]
        rest = [p for p in new if not (p[0] == " " and p[1:].isalpha())]
        groups = [plain[i : i + GROUP] for i in range(0, len(plain), GROUP)]
        got: dict[str, int] = {}
        for group, one in zip(groups, self._library.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(one.ids)
            starts = np.flatnonzero(self._opens[ids])
            if len(starts) == len(group) and starts[0] == 0:
                got.update(zip(group, np.diff(starts, append=len(ids)).tolist(), strict=True))
            else:
                rest += group
        got.update(zip(rest, map(len, self._library.encode_batch_fast(rest, add_special_tokens=False)), strict=True))
        return got


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(path)
    return _counters[path]


_number = regex.compile(r"\d[\d ().-]{7}")
_patterns: dict[tuple[int, ...], regex.Pattern] = {}


def redactions(text: str) -> list[Edit]:
    """Non-overlapping edits from left to right. Rules that find nothing in the text,
    by what each of their matches must hold, are left out before the search."""
    email, number = "@" in text, _number.search(text) is not None
    key = max(map(len, text.split()), default=0) >= 24
    rules = tuple(i for i, may in enumerate((email, number, key)) if may)
    if not rules:
        return []
    if rules not in _patterns:
        _patterns[rules] = regex.compile("|".join(f"({REDACTIONS[i][0]})" for i in rules))
    return [(m.start(), m.end(), REDACTIONS[rules[m.lastindex - 1]][1]) for m in _patterns[rules].finditer(text)]


TREE = "doc_id long, text string, lengths binary, counts binary"


def build_trees(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text, lengths, counts (32-bit numbers, one a leaf) of every row of docs (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, GROUP):
                part = batch.slice(low, GROUP)
                cut = [own.cut(text) for text in part.column(1).to_pylist()]
                leaves = [x for one in cut for x in one]
                lengths, counts = np.fromiter(map(len, leaves), "<u4", len(leaves)), own(leaves).astype("<u4")
                ends = np.cumsum([0, *map(len, cut)]).tolist()
                packed = [pa.array([x[i:j].tobytes() for i, j in zip(ends, ends[1:], strict=False)], pa.binary()) for x in (lengths, counts)]
                yield pa.RecordBatch.from_arrays([*part.columns, *packed], ["doc_id", "text", "lengths", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, TREE)


def edit_trees(trees: DataFrame, tokenizer: str, edits_of: Callable[[str], list[Edit]] = redactions, with_trees: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_recut of every row of build_trees, and with
    them text, lengths and counts after the edits. n_recut: pre-tokens that the edits made it
    cut and encode again."""
    ship(trees.sparkSession)
    names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_recut"] + ["text", "lengths", "counts"] * with_trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            rows, after = [], []
            for text, lengths, counts in zip(*(c.to_pylist() for c in batch.columns[1:4]), strict=True):
                lengths, counts = np.frombuffer(lengths, "<u4"), np.frombuffer(counts, "<u4")
                edits = edits_of(text)
                if not edits:
                    n = int(counts.sum(dtype=np.int64))
                    rows.append((n, 0, n, 0))
                    after.append((text, lengths, counts))
                    continue
                tree = CountTree(text, lengths, counts, own.cut, own)
                before = tree.total
                for start, end, new in reversed(edits):
                    tree.edit(start, end, new)
                rows.append((before, len(edits), tree.total, tree.n_recut))
                if with_trees:
                    after.append((tree.text(), *tree.leaves()))
            cols = [batch.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(4))]
            if with_trees:
                cols += [pa.array([x[0] for x in after], pa.string()), *(pa.array([x[i].astype("<u4").tobytes() for x in after], pa.binary()) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_recut long"
    return trees.select("doc_id", "text", "lengths", "counts").mapInArrow(run, schema + ", text string, lengths binary, counts binary" * with_trees)


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return edit_trees(staged(build_trees(table(spark, sf_dir, "documents"), path), "edit-trees"), path)
