"""LM scoring by a gated recurrent language model in numpy.

Counts of every distinct token over all training texts are gathered first; they
give the base score and the vocabulary. The model knows the most frequent tokens, the
distinct ones to the power GROWTH, so their number grows with the input; its
output softmax is factored: a class of equally ranked tokens, then the token in
its class, as many classes as tokens in each. All other words stand in as many
more classes by their endings, which are inputs and outputs of their own: within
one a word's probability is its share of the counts (plus one each, plus one for
all unseen words of the class), so the model gives a probability to every text.

Every text is turned into ids once; these rows, in the shared folder, serve training
and scoring. Training is truncated backpropagation over windows of WINDOW tokens; the
state is carried from window to window and reset where a text begins. Trainers, as
many as the training texts have TRAINER_TOKENS, run apart from one start and their
weights are averaged by tokens. Every token of every training text is learnt from
once; texts are dealt to trainers and ordered by a hash of their row.

Scoring runs over whole texts with the state carried across windows, many texts
side by side. Words beyond the most frequent BROADCAST_WORDS (ties go by a hash of the word) are
counted through a join, so what is sent to every task has a fixed bound.

Edge cases: null counts as empty text, of which the end alone is scored. Repeated
rows each get a row. A very long text is one long stream of windows; its ids are held
at once. With no training text all counts are 0. An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, lean, most_counted, staged, table, text_bytes
from tidemark.sources.ship import ship

HIDDEN, WINDOW = 16, 32
#: Streams side by side, more of them for many tokens, so that at least STEPS windows are learnt from.
FEWEST_STREAMS, MOST_STREAMS, STEPS = 64, 256, 500
#: Classes of known tokens, and tokens in each, at least; the known ones are the distinct ones to the power GROWTH.
LEAST_CLASSES, GROWTH = 32, 0.625
#: Bytes of the ending that gives another word its class.
ENDING = 3
#: The input before a text's first token: the last row of the inputs.
START = -1
TRAINER_TOKENS = 4_000_000
#: Parameters that are averaged together.
BLOCK = 1 << 16
RATE = 0.01
BROADCAST_WORDS = 200_000
#: Multiplications up to which a product of matrices is quickest (a library's own limit for small
#: ones), rows of a product at least, texts that are scored side by side, and logits up to which
#: exponentials need no shift.
SMALL, FEWEST_ROWS, ABREAST, SAFE = 1_000_000, 64, 1024, 60.0
#: Numbers of each array that a step of the weights takes at once.
HELD = 1 << 15
#: Bytes of texts that are split at once, and of words that are counted at once.
PIECE, COUNTED = 1 << 23, 1 << 25
#: The end of a text, as a token; no word is empty.
END = b""
#: What a byte does to a crc32.
CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = np.where(CRC_TABLE & 1, (CRC_TABLE >> 1) ^ np.uint32(0xEDB88320), CRC_TABLE >> 1)


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between the six blanks, then the end."""
    return [*text.lower().split(), END]


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, PIECE bytes of the column at a time, or a longer row."""
    upto, low = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64), 0
    while low < len(upto):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + PIECE, "right")))
        yield batch.slice(low, high - low)
        low = high


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased (A-Z) words of all texts (binary), and how many there are up to each text's end."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words, ends = lists.flatten().view(pa.binary()), lists.offsets.to_numpy()[1:]
    filled = pc.binary_length(words).to_numpy() > 0  # blanks at the sides of a text leave empty ones
    if not filled.all():
        words, ends = words.filter(pa.array(filled)), np.append(0, np.cumsum(filled))[ends]
    return words, ends


def ending_crcs(words: pa.Array) -> np.ndarray:
    """crc32 of the last ENDING bytes of each word (binary)."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    crc, lengths, ends = np.full(len(words), 0xFFFFFFFF, np.uint32), np.diff(at), at[1:]
    for back in range(ENDING, 0, -1):
        some = np.flatnonzero(lengths >= back)
        if len(some):
            had = crc[some]
            crc[some] = CRC_TABLE[(had ^ np.frombuffer(data, np.uint8)[ends[some] - back]) & 0xFF] ^ (had >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def count_tokens(training: DataFrame) -> DataFrame:
    """w, c over all texts of ``training`` (text as binary)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_texts = [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(pc.value_counts(pa.chunked_array(held, pa.binary())).flatten(), ["w", "c"])

        for batch in batches:
            n_texts += batch.num_rows
            for part in pieces(batch, 0):
                held.append(split_words(part.column(0))[0])
                size += held[-1].nbytes
                if size > COUNTED:
                    yield flush()
                    held, size = [], 0
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([n_texts], pa.int64())], ["w", "c"])

    return training.select("text").mapInArrow(lean(count), "w binary, c long").where("c > 0").groupBy("w").agg(F.sum("c").alias("c"))


def small(numbers: np.ndarray, upto: int) -> np.ndarray:
    """Numbers below upto, in 16 bits where they fit: a stable sort of these goes by digits."""
    return numbers.astype(np.uint16) if upto <= 1 << 16 else numbers


def sums_by(group: np.ndarray, rows: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups (numbers below n_groups) that occur, and for each the sums of rows' columns (their
    second axis, the others as in group)."""
    group = group.ravel()
    found = np.zeros(n_groups, bool)
    found[group] = True
    used, place = np.flatnonzero(found), np.empty(n_groups, np.intp)
    place[used] = np.arange(len(used))
    group, out = place[group], np.empty((rows.shape[1], len(used)), rows.dtype)
    for k, sums in enumerate(out):
        sums[:] = np.bincount(group, rows[:, k].ravel(), len(used))
    return used, out.T


def moved(weights: np.ndarray, grad: np.ndarray, first: np.ndarray, second: np.ndarray, scale: float, n: int, rate: float) -> None:
    """Adam's n-th step over flat arrays, in place, by blocks that stay in a cache; scale: of the gradient."""
    one, two = rate / (1 - 0.9**n), math.sqrt(1 - 0.99**n)
    for low in range(0, len(weights), HELD):
        part = slice(low, low + HELD)
        d, a, b = grad[part], first[part], second[part]
        a *= 0.9
        t = d * (0.1 * scale)
        a += t
        np.multiply(d, d, out=t)
        t *= 0.01 * scale * scale
        b *= 0.99
        b += t
        np.sqrt(b, out=t)
        t += 1e-6 * two
        np.divide(a, t, out=t)
        t *= one * two
        weights[part] -= t


def with_ones(states: np.ndarray) -> np.ndarray:
    """States (steps, H, n) as rows with a last column of ones: (steps, n, H + 1)."""
    out = np.ones((len(states), states.shape[2], HIDDEN + 1), states.dtype)
    out[:, :, :HIDDEN] = states.transpose(0, 2, 1)
    return out


class Gru:
    """Parameters and passes. Ids: of known tokens their rank, of other words the
    number of places for known ones plus their class. Shapes: x (places + other classes
    + 1, 3H), u (H, 3H), bu (3H), wc (H + 1, classes + other classes), wo (classes,
    H + 1, classes); the last row of wc and wo is the bias."""

    def __init__(self, counts: np.ndarray, other: float | np.ndarray, classes: int = LEAST_CLASSES, seed: int = 7) -> None:
        """counts: of the known tokens, by rank; other: of the other classes. The biases start at the counts' shares."""
        r = np.random.Generator(np.random.PCG64(seed))
        self.classes, other = classes, np.maximum(np.atleast_1d(other), 0.1)
        share = np.zeros(classes * classes)
        share[: len(counts)] = counts
        share = (share + 0.1).reshape(classes, classes)
        wc, wo = np.zeros((HIDDEN + 1, classes + len(other))), np.zeros((classes, HIDDEN + 1, classes))
        wc[HIDDEN] = np.log(np.append(share.sum(1), other) / (share.sum() + other.sum()))
        wo[:, HIDDEN] = np.log(share / share.sum(1, keepdims=True))
        x, u = r.normal(0, 0.3, (classes * classes + len(other) + 1, 3 * HIDDEN)), r.normal(0, 0.2, (HIDDEN, 3 * HIDDEN))
        self.p = {k: v.astype(np.float32) for k, v in {"x": x, "u": u, "bu": np.zeros(3 * HIDDEN), "wc": wc, "wo": wo}.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, v: np.ndarray) -> Gru:
        at = 0
        for k, old in self.p.items():
            self.p[k] = v[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return self

    def step(self, h: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The next state from states h and inputs a (rows of x), a column each. What the way back
        needs is left in b, the gates z and r and what the gate r scales one above the other, and
        in c, the candidate."""
        np.matmul(self.p["u"].T, h, out=b)
        b += self.p["bu"][:, None]
        gates = b[: 2 * HIDDEN]
        gates += a[: 2 * HIDDEN]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[HIDDEN:], b[2 * HIDDEN :], out=c)
        c += a[2 * HIDDEN :]
        np.tanh(c, out=c)
        new = c - h
        new *= gates[:HIDDEN]
        new += h
        return new

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """x of ids (steps, n), as step() takes them: (steps, 3H, n)."""
        x = self.p["x"]
        out = np.empty((len(ids), 3 * HIDDEN, ids.shape[1]), x.dtype)
        for own, step in zip(out, ids, strict=True):  # so many rows stay in a cache
            own[:] = np.take(x, step, 0).T
        return out

    def shifts(self) -> tuple[bool, bool]:
        """Whether the exponentials of classes, and of tokens in them, need a shift."""
        return bool(np.abs(self.p["wc"]).sum(0).max() > SAFE), bool(np.abs(self.p["wo"]).sum(1).max() > SAFE)

    def log_probs(
        self, states: np.ndarray, ids: np.ndarray, grads: bool = False, live: np.ndarray | None = None, shifts: tuple[bool, bool] | None = None
    ) -> tuple[np.ndarray, dict, np.ndarray]:
        """Natural logs for targets ids (of other words those of their class) after states
        (their last column is one); with grads, those of the negative sum. live: the targets that
        count; shifts: of these weights."""
        p, size, kind = self.p, self.classes, states.dtype
        places, width = size * size, p["wc"].shape[1]
        cls = np.where(ids < places, ids // size, ids - places + size)
        # beside the weights that lead back to the states, a column of ones gives the sums
        back = np.ones((width, HIDDEN + 1), kind)
        back[:, :HIDDEN] = p["wc"][:HIDDEN].T
        of_class = np.zeros((HIDDEN + 1, width), kind)
        counted = states if live is None else states * live[:, None]
        n_rows = max(FEWEST_ROWS, SMALL // p["wc"].size)
        shift, shift_inner = shifts or self.shifts()
        held, firsts = np.empty((n_rows, width), kind), np.arange(n_rows) * width
        flat, hit, both = held.ravel(), np.empty(len(ids), kind), np.empty((len(ids), HIDDEN + 1 if grads else 1), kind)
        for low in range(0, len(ids), n_rows):
            part = slice(low, low + n_rows)
            at = cls[part] + firsts[: len(ids) - low]
            e = np.matmul(states[part], p["wc"], out=held[: len(at)])
            if shift:
                e -= e.max(1, keepdims=True)
            hit[part] = flat[at]
            np.exp(e, out=e)
            total = np.matmul(e, back if grads else back[:, HIDDEN:], out=both[part])[:, -1]
            if grads:
                flat[at] -= total
                of_class += (counted[part] / total[:, None]).T @ e
        out = hit - np.log(both[:, -1])
        inner = np.flatnonzero(ids < places if live is None else (ids < places) & live)
        order = inner[np.argsort(small(cls[inner], size), kind="stable")]
        found, back_in, of_place = self._inner(np.take(states, order, 0), ids[order], grads, shift_inner)
        out[order] += found
        if live is not None:
            out *= live
        if not grads:
            return out, {}, both[:, :0]
        dh = both[:, :HIDDEN] / both[:, HIDDEN:]
        dh -= np.take(back, cls, 0)[:, :HIDDEN]
        if live is not None:
            dh *= live[:, None]
        dh[order] += back_in
        return out, {"wc": of_class, "wo": of_place}, dh

    def _inner(self, own: np.ndarray, ids: np.ndarray, grads: bool, shift: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logs within the classes, for known tokens sorted by class; with grads also what leads
        back to the states, and wo's gradient. Each class goes by pieces of rows, and the pieces
        of so many rows as stay in a cache go through the exponentials together."""
        wo, size, kind = self.p["wo"], self.classes, own.dtype
        cls, place = ids // size, ids % size
        most = max(FEWEST_ROWS, SMALL // ((HIDDEN + 1) * size))
        n_of = np.bincount(cls, minlength=size)
        ends = np.cumsum(n_of).tolist()
        begins, back, of_place = [0, *ends], np.ones((size if grads else 1, size, HIDDEN + 1), kind), wo
        if grads:
            back[:, :, :HIDDEN] = wo[:, :HIDDEN].transpose(0, 2, 1)
            of_place = np.empty_like(wo)
            of_place[n_of == 0] = 0
        hit, both = np.empty(len(ids), kind), np.empty((len(ids), HIDDEN + 1 if grads else 1), kind)
        held, firsts = np.empty((most, size), kind), np.arange(most) * size
        flat, k, low = held.ravel(), 0, 0
        while low < len(ids):
            high, pieces, at = min(low + most, len(ids)), [], low
            while at < high:
                while ends[k] <= at:
                    k += 1
                end = min(ends[k], high)
                pieces.append((k, slice(at, end), slice(at - low, end - low)))
                at = end
            part = slice(low, high)
            e = held[: high - low]
            for c, rows, here in pieces:
                np.matmul(own[rows], wo[c], out=held[here])
            if shift:
                e -= e.max(1, keepdims=True)
            target = place[part] + firsts[: high - low]
            hit[part] = flat[target]
            np.exp(e, out=e)
            if not grads:
                both[part] = e @ back[0, :, HIDDEN:]
            else:
                for c, rows, here in pieces:
                    np.matmul(held[here], back[c], out=both[rows])
                total = both[part, HIDDEN]
                flat[target] -= total
                scaled = (own[part] / total[:, None]).T
                for c, rows, here in pieces:
                    if rows.start == begins[c]:
                        np.matmul(scaled[:, here], held[here], out=of_place[c])
                    else:
                        of_place[c] += scaled[:, here] @ held[here]
            low = high
        found = hit - np.log(both[:, -1])
        if not grads:
            return found, own, wo
        return found, both[:, :HIDDEN] / both[:, HIDDEN:] - np.take(back.reshape(-1, HIDDEN + 1), ids, 0)[:, :HIDDEN], of_place

    def window(self, h: np.ndarray, ids: np.ndarray, targets: np.ndarray, live: np.ndarray | None = None) -> tuple[np.ndarray, float, dict]:
        """One window of truncated backpropagation: (streams, steps) ids, targets and, unless
        all count, which do. The gradient of x is given by rows: (ids, sums)."""
        (n, steps), u = ids.shape, self.p["u"]
        ids = np.ascontiguousarray(ids.T)
        inputs, begins, h = self.inputs(ids), ids == START, np.ascontiguousarray(h.T)
        some = begins.any(1).tolist()
        before, after, c = (np.empty((steps, HIDDEN, n), u.dtype) for _ in range(3))
        b = np.empty((steps, 3 * HIDDEN, n), u.dtype)
        for t in range(steps):
            if some[t]:
                h = np.where(begins[t], u.dtype.type(0), h)
            before[t] = h
            after[t] = h = self.step(h, inputs[t], b[t], c[t])
        out, g, dout = self.log_probs(with_ones(after).reshape(-1, HIDDEN + 1), targets.T.ravel(), True, None if live is None else live.T.ravel())
        dout = np.ascontiguousarray(dout.reshape(steps, n, HIDDEN).transpose(0, 2, 1))
        z, r, scaled = b[:, :HIDDEN], b[:, HIDDEN : 2 * HIDDEN], b[:, 2 * HIDDEN :]
        keep, of_c = 1 - z, z * (1 - c * c)
        of_z, of_r = (c - before) * z * keep, scaled * r * (1 - r)
        # what leads back to the candidate, z, r and what r scales: the first three to x, the last three to u
        d, dh = np.empty((steps, 4 * HIDDEN, n), u.dtype), np.zeros((HIDDEN, n), u.dtype)
        for t in range(steps - 1, -1, -1):
            dh += dout[t]
            dc = np.multiply(dh, of_c[t], out=d[t, :HIDDEN])
            np.multiply(dh, of_z[t], out=d[t, HIDDEN : 2 * HIDDEN])
            np.multiply(dc, of_r[t], out=d[t, 2 * HIDDEN : 3 * HIDDEN])
            np.multiply(dc, r[t], out=d[t, 3 * HIDDEN :])
            dh *= keep[t]
            dh += u @ d[t, HIDDEN:]
            if some[t]:
                dh[:, begins[t]] = 0
        db = d[:, HIDDEN:]
        g["u"], g["bu"] = np.matmul(before, db.transpose(0, 2, 1)).sum(0), db.sum((0, 2))
        used, sums = sums_by(np.where(begins, len(self.p["x"]) + START, ids), d[:, : 3 * HIDDEN], len(self.p["x"]))
        g["x"] = (used, np.roll(sums, -HIDDEN, 1))
        return h.T, -float(out.sum()), g

    def train(self, texts: list[np.ndarray], rate: float = RATE) -> int:
        """One pass over the texts (ids with their end), laid out as streams; the number of tokens."""
        if not texts:
            return 0
        targets = np.concatenate(texts)
        n_tokens = len(targets)
        inputs = np.empty_like(targets)
        inputs[1:] = targets[:-1]
        inputs[np.cumsum([0, *map(len, texts[:-1])])] = START
        streams = min(MOST_STREAMS, max(FEWEST_STREAMS, n_tokens // (STEPS * WINDOW)))
        streams = max(1, min(streams, n_tokens // WINDOW))
        steps = -(-n_tokens // streams)
        spare = streams * steps - n_tokens  # the last streams are filled up with places that don't count
        live = np.arange(streams * steps).reshape(streams, steps) < n_tokens
        targets = np.append(targets, np.zeros(spare, targets.dtype)).reshape(streams, steps)
        inputs = np.append(inputs, np.full(spare, START, inputs.dtype)).reshape(streams, steps)
        inputs[:, 0] = START
        h = np.zeros((streams, HIDDEN), np.float32)
        first, second, n = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for at in range(0, steps, WINDOW):
            part = live[:, at : at + WINDOW]
            h, _, g = self.window(h, inputs[:, at : at + WINDOW], targets[:, at : at + WINDOW], None if part.all() else part)
            n += 1
            scale = float(1 / part.sum())
            for k, d in g.items():
                p, a, b = self.p[k], first[k], second[k]
                if k != "x":
                    moved(p.reshape(-1), d.reshape(-1), a.reshape(-1), b.reshape(-1), scale, n, rate)
                    continue
                rows, d = d  # moments of x move where there is a gradient
                own, whole = [np.take(v, rows, 0) for v in (p, a, b)], f"V{p[0].nbytes}"
                moved(own[0].reshape(-1), d.reshape(-1), own[1].reshape(-1), own[2].reshape(-1), scale, n, rate)
                for v, now in zip((p, a, b), own, strict=True):  # a row at a time
                    v.view(whole)[rows] = now.view(whole)
        return n_tokens

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each text (ids with their end), the state carried across windows."""
        out, order, shifts = np.zeros(len(texts)), np.argsort([-len(t) for t in texts], kind="stable"), self.shifts()
        for i in range(0, len(texts), ABREAST):
            part = order[i : i + ABREAST]
            out[part] = self._score([texts[k] for k in part], shifts)
        return out

    def _score(self, texts: list[np.ndarray], shifts: tuple[bool, bool]) -> np.ndarray:
        """The longest first."""
        flat, lengths = np.concatenate(texts), np.array([len(t) for t in texts])
        starts, out = np.cumsum(lengths) - lengths, np.zeros(len(texts))
        h, last = np.zeros((HIDDEN, len(texts)), np.float32), np.full(len(texts), START)
        for at in range(0, int(lengths[0]), WINDOW):
            live = np.searchsorted(-lengths, -(at + np.arange(min(WINDOW, int(lengths[0]) - at))), "left")  # texts longer than that
            n, steps = int(live[0]), len(live)
            places = np.minimum(starts[:n] + at + np.arange(steps)[:, None], len(flat) - 1)
            ids = flat[places]
            inputs, after = self.inputs(np.concatenate([last[None, :n], ids[:-1]])), np.zeros((steps, HIDDEN, n), np.float32)
            for t, m in enumerate(live.tolist()):
                h = self.step(h[:, :m], inputs[t, :, :m], np.empty((3 * HIDDEN, m), np.float32), np.empty((HIDDEN, m), np.float32))
                after[t, :, :m] = h
            last, counts, states = ids[-1], np.arange(n) < live[:, None], with_ones(after)
            of = np.nonzero(counts)[1]
            every = len(of) == counts.size  # then nothing is to be picked
            logs = self.log_probs(states.reshape(-1, HIDDEN + 1) if every else states[counts], ids.ravel() if every else ids[counts], shifts=shifts)[0]
            out += np.bincount(of, logs, len(texts))
        return out


def class_count(distinct: int) -> int:
    """Classes of known tokens, tokens in each, and classes of other words."""
    return max(LEAST_CLASSES, math.ceil(distinct ** (GROWTH / 2)))


def ending_sums(counts: DataFrame, classes: int) -> dict[int, int]:
    """The counts of all tokens, plus one each, by the class of their ending."""
    ending = F.pmod(F.crc32(F.substring("w", -ENDING, ENDING)), F.lit(classes))
    return dict(counts.groupBy(ending.alias("ending")).agg(F.sum(F.col("c") + 1)).collect())  # at most one row a class


class Vocabulary:
    """Row, count and id of the most frequent tokens, and the sums of the other words' classes."""

    def __init__(self, frequent: list[tuple[bytes, int]], classes: int, endings: dict[int, int]) -> None:
        """frequent: the most frequent first; endings: what ending_sums gives."""
        self.classes, self.places = classes, classes * classes
        self.rows = {w: i for i, (w, _) in enumerate(frequent)}
        self.counts = np.array([c for _, c in frequent], np.int64)
        self.n_known = min(len(frequent), self.places)
        self._ids = np.array([i if i < self.places else self.places + self._ending(w) for i, (w, _) in enumerate(frequent)], np.int32)
        #: the counts, plus one each and one for the unseen, of the other words of each class
        self.rest = np.array([endings.get(k, 0) + 1 for k in range(classes)], float)
        for w, c in frequent[: self.places]:
            self.rest[self._ending(w)] -= c + 1

    def _ending(self, word: bytes) -> int:
        return zlib.crc32(word[-ENDING:]) % self.classes

    def model(self) -> Gru:
        return Gru(self.counts[: self.n_known].astype(float), self.rest, self.classes)

    def find(self, words: pa.Array) -> np.ndarray:
        """Each word's row among the most frequent (-1: none)."""
        return pc.index_in(words, pa.array(list(self.rows), pa.binary())).fill_null(-1).to_numpy()

    def ids_of(self, words: pa.Array, rows: np.ndarray) -> np.ndarray:
        """The ids of words with these rows."""
        ids, missing = self._ids[rows] if len(self._ids) else np.zeros(len(words), np.int32), np.flatnonzero(rows < 0)
        ids[missing] = self.places + ending_crcs(words.take(pa.array(missing))) % np.uint32(self.classes)
        return ids

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Each word's row among the most frequent (-1: none) and its id."""
        words = pa.array(words, pa.binary())
        return (rows := self.find(words)), self.ids_of(words, rows)


def _encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """For each row k (its number), doc_id, held_out, n_tokens; seen and base: tokens among the
    most frequent and the logs of their counts; outside: logs of those that the model
    doesn't know itself, less the logs of their classes; ids; rare: the other words."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["k", "doc_id", "held_out", "n_tokens", "seen", "base", "outside", "ids", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        logs, rest, row = np.append(np.log10(own.counts + 1), 0.0), np.log10(own.rest), TaskContext.get().partitionId() << 40
        end = own.look_up([END])
        for batch in batches:
            for piece in pieces(batch, 1):
                # a word more holds the place of each text's end
                all_words, upto = split_words(pc.binary_join_element_wise(piece.column(1), b"x", b" "))
                all_found, upto = own.find(all_words), np.append(0, upto)
                for low in range(0, piece.num_rows, 512):
                    part = piece.slice(low, 512)
                    n, first = part.num_rows, int(upto[low])
                    starts, ends = upto[low : low + n] - first, upto[low + 1 : low + n + 1] - first
                    words, found = all_words.slice(first, ends[-1]), all_found[first : first + ends[-1]].astype(np.int64)
                    ids = own.ids_of(words, found)
                    found[ends - 1], ids[ends - 1] = end
                    missing, other = np.flatnonzero(found < 0), np.flatnonzero(ids >= own.places)
                    outside = np.zeros(len(words))
                    outside[other] = logs[found[other]] - rest[ids[other] - own.places]
                    rare = words.take(pa.array(missing))
                    if end[0] < 0:
                        rare = pc.if_else(pa.array(np.isin(missing, ends - 1)), pa.scalar(END, pa.binary()), rare)
                    rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(missing, np.append(0, ends)), pa.int32()), rare)
                    sums = [np.add.reduceat(x, starts) for x in ((found >= 0).astype(np.int64), logs[found], outside)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(row, row + n)), part.column(0), part.column(2), pa.array((ends - starts).astype(np.int64)), *map(pa.array, sums), pa.array([ids[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()), rare],
                        names,
                    )
                    row += n

    return rows.mapInArrow(lean(run), "k long, doc_id long, held_out boolean, n_tokens long, seen long, base double, outside double, ids binary, rare array<binary>")


def _train(training: DataFrame, vocabulary: Vocabulary, n_trainers: int) -> Gru:
    """training: k, ids of every training text."""
    shared = training.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, texts = shared.value.model(), []
        for batch in batches:
            texts += [np.frombuffer(x, np.int32) for x in batch.column(0).to_pylist()]
        if n := model.train(texts):
            v = model.vector().astype("<f4")
            blocks = range(0, len(v), BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([v[i : i + BLOCK].tobytes() for i in blocks], pa.binary()), pa.array([n] * len(blocks), pa.int64())], ["i", "v", "n"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[np.ndarray, int]] = {}
        for batch in batches:
            for i, v, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                had, m = sums.get(i, (0.0, 0))
                sums[i] = had + np.frombuffer(v, "<f4").astype(float) * n, m + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([(v / n).astype("<f4").tobytes() for v, n in sums.values()], pa.binary())], ["i", "v"])

    place = F.xxhash64("k")
    dealt = training.select("ids", place.alias("place"), "k").repartition(n_trainers, "place").sortWithinPartitions("place", "k")
    trained = dealt.select("ids").mapInArrow(run, "i long, v binary, n long")
    # one order of the sums, so that reruns agree
    rows = trained.repartition("i").sortWithinPartitions("i", "n", "v").mapInArrow(average, "i long, v binary").collect()  # the parameters once
    model = vocabulary.model()
    if rows:
        model.load(np.frombuffer(b"".join(bytes(r.v) for r in sorted(rows, key=lambda r: r.i)), "<f4"))
    return model


def score_documents(docs: DataFrame, in_training: object) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row
    of docs (doc_id, text); in_training: a condition on doc_id."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), (~in_training).alias("held_out"))
    counts = staged(count_tokens(rows.where(~F.col("held_out"))), "gru-counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    classes = class_count(totals.v)
    vocabulary = Vocabulary(most_counted(counts, "w", BROADCAST_WORDS), classes, ending_sums(counts, classes))
    encoded = staged(_encode(rows, vocabulary), "gru-encoded")
    model = _train(encoded.where(~F.col("held_out")), vocabulary, max(1, round(totals.n / TRAINER_TOKENS)))
    shared = spark.sparkContext.broadcast(model)
    names = ["k", "doc_id", "held_out", "n_tokens", "seen", "base", "outside", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score([np.frombuffer(x, np.int32) for x in batch.column(7).to_pylist()]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(scores)], names)

    scored = encoded.select(*names[:7], "ids").mapInArrow(run, "k long, doc_id long, held_out boolean, n_tokens long, seen long, base double, outside double, model double")
    words = encoded.select("k", F.explode("rare").alias("w"))
    looked = words.join(counts, "w", "left").groupBy("k").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("logs"), F.count("c").alias("known"))
    joined = scored.join(looked, "k", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("seen") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(totals.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * float(np.log10(totals.n + totals.v + 1))).alias("base_score"), (F.col("model") + F.col("outside") + logs).alias("score"),
    )


def op10_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
