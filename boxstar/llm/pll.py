"""Masked pseudo-likelihood scores (operator 1).

A small network in numpy predicts each token from the two tokens on its left
and the two on its right; a document's score is the sum of the logarithms of
these conditional probabilities.

* Tokens are lower-cased white-space words. A distributed table holds the exact
  count of every word of the corpus. Words fall into hash slots; the most
  frequent slots have a code of their own and the others share codes by slot.
  There are as many own codes as frequent words (seen at least ``FREQUENT``
  times and a quarter of the square root of the number of tokens), ``TOP`` at
  least, so codes and slots grow with the corpus.
* A token's probability is P(code | window) * P(word | code). The second factor
  is n(word) / (n(code) + 1) by the exact counts; all words that the corpus does
  not hold share the one count left in their code. The counts of the ``HEAD``
  most frequent words go to every task, those of all others are joined by word.
* Network: an embedding per window place, summed, tanh, then the code's upper
  half by softmax and its lower half by a second softmax given the upper one.
  The product is a proper distribution over codes.
* Training: every document masks one position in ``MASK`` (by a hash of the position)
  and learns to predict it; each task trains on all of its documents, the
  tasks' parameters are averaged by work. The words seen, the counts and the
  training work all grow with the corpus.

Defined results: a NULL or empty text has no token, score 0 and no mean; a NULL doc_id stays NULL;
repeated rows give repeated result rows; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.averaging import train_averaged
from boxstar.llm.common import land, prepare

SLOTS = 1 << 16
CODES = 1024
TOP = 960
SIDE = 32  # CODES == SIDE * SIDE
EDGE = CODES  # code beyond a text's ends; side * side where there are more codes
FREQUENT = 100
HEAD = 100_000
WINDOW = (-2, -1, 1, 2)
WIDTH = 16
MASK = 8
STEP = 0.1
MINIBATCH = 2048
MAX_WORDS = 300_000

def _shapes(side: int) -> dict[str, tuple[int, ...]]:
    return {
        "places": (len(WINDOW), side * side + 1, WIDTH),
        "bias": (WIDTH,),
        "upper": (WIDTH, side),
        "upper_bias": (side,),
        "gate": (side, WIDTH),
        "lower": (WIDTH, side),
        "lower_bias": (side, side),
    }


def _size(side: int) -> int:
    return sum(int(np.prod(s)) for s in _shapes(side).values())


def _side(size: int) -> int:
    """The side whose parameter vector has this length."""
    side = int(np.sqrt(size / (len(WINDOW) * WIDTH + 1)))
    return max((k for k in range(max(1, side - 2), side + 2) if _size(k) <= size), default=1)


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Named views into a flat parameter vector."""
    out, at = {}, 0
    for name, shape in _shapes(_side(len(flat))).items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def _slot(word: str, slots: int = SLOTS) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & (slots - 1)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: Counter[str] = Counter()

    def counted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for t in batch.column(0):
            words.update((t.as_py() or "").lower().split())
        if len(words) > MAX_WORDS:
            yield counted()
            words.clear()
    yield counted()


def word_table(docs: DataFrame) -> DataFrame:
    """Every word of the corpus with its exact count (word, n), as a stored table."""
    prepare(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_count_words, "word string, n long")
    return land(counted.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")


def _by_count(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(count, number of words with it), highest count first."""
    table = words.groupBy("n").agg(F.count(F.lit(1)).alias("k")).toArrow()
    n, k = table["n"].to_numpy(), table["k"].to_numpy()
    order = np.argsort(-n)
    return n[order], k[order]


def code_table(docs: DataFrame, words: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(code of each slot, corpus count of each code)."""
    words = word_table(docs) if words is None else words
    n, k = _by_count(words)
    least = max(FREQUENT, np.sqrt(float((n * k).sum())) / 4)
    own = max(TOP, int(k[n >= least].sum()))
    side = SIDE
    while side * side * TOP // CODES < own:
        side += 8
    top = side * side * TOP // CODES
    slots = SLOTS
    while slots < 64 * top:
        slots *= 2
    slot = F.crc32(F.col("word").cast("binary")).bitwiseAND(F.lit(slots - 1))
    table = words.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).toArrow()  # one row per slot at most
    count = np.zeros(slots, dtype=np.int64)
    count[table["slot"].to_numpy()] = table["n"].to_numpy()
    order = np.lexsort((np.arange(slots), -count))
    codes = (top + np.arange(slots) % (side * side - top)).astype(np.int64)
    codes[order[:top]] = np.arange(top)
    # neighbours in rank get different upper bits, so that both softmaxes share the work
    mixed = (codes % side) * side + codes // side
    return mixed, np.bincount(mixed, weights=count, minlength=side * side)


def frequent_words(words: DataFrame, head: int = HEAD) -> dict[str, int]:
    """The counts of the most frequent words, ``head`` at most; words of equal count go together."""
    n, k = _by_count(words)
    inside = n[np.cumsum(k) <= head]
    if not len(inside):
        return {}
    table = words.where(F.col("n") >= int(inside[-1])).toArrow()
    return dict(zip(table["word"].to_pylist(), table["n"].to_pylist()))


def initial(counts: np.ndarray, seed: int = 1) -> np.ndarray:
    """Small random weights; the output biases are the corpus frequencies."""
    rng = np.random.default_rng(seed)
    side = int(round(np.sqrt(len(counts))))
    flat = (rng.standard_normal(_size(side)) * 0.08).astype(np.float32)
    p = unflatten(flat)
    table = (counts + 0.5).reshape(side, side)
    p["bias"][:] = 0
    p["gate"][:] = 1
    p["upper_bias"][:] = np.log(table.sum(axis=1) / table.sum())
    p["lower_bias"][:] = np.log(table / table.sum(axis=1, keepdims=True))
    return flat


class Words(dict):
    """word -> number, given as words are met; by number the word's code, the log of its
    count if it is one of ``head`` (else NaN), and the word. Number 0 is a text's edge."""

    def __init__(self, codes: np.ndarray, edge: int, head: dict[str, int] | None = None):
        super().__init__()
        self.slots, self.edge, self.head = codes, edge, head or {}
        self.start()

    def start(self) -> None:
        self.clear()
        self.names: list[str] = [""]
        self.code_list, self.log_list = [self.edge], [0.0]
        self.code_array, self.log_array = np.zeros(0, np.int64), np.zeros(0)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.names)
        self.names.append(word)
        self.code_list.append(int(self.slots[_slot(word, len(self.slots))]))
        n = self.head.get(word)
        self.log_list.append(math.nan if n is None else math.log(n))
        return number

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens of all texts in one array, two edges around each text, and each
        text's number of tokens. Forgets the words of earlier batches if they are many."""
        if len(self.names) > MAX_WORDS:
            self.start()
        flat: list[int] = [0, 0]
        lengths = []
        for t in texts:
            before = len(flat)
            flat += map(self.__getitem__, (t.as_py() or "").lower().split())
            lengths.append(len(flat) - before)
            flat += (0, 0)
        return np.array(flat, dtype=np.int64), np.array(lengths, dtype=np.int64)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        self.code_array = np.append(self.code_array, np.array(self.code_list[len(self.code_array) :], dtype=np.int64))
        return self.code_array[numbers]

    def logs(self, numbers: np.ndarray) -> np.ndarray:
        self.log_array = np.append(self.log_array, np.array(self.log_list[len(self.log_array) :]))
        return self.log_array[numbers]


def _masked(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which tokens a text masks for training: one in ``MASK``, by a hash of the place and
    of the text's codes, so no period of a table or log is masked in step."""
    ends = np.cumsum(lengths)
    own = np.add.reduceat(np.append(codes, 0), np.minimum(ends - lengths, len(codes))) if len(lengths) else np.zeros(0, np.int64)
    place = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
    mixed = (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.repeat(own, lengths).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)) % np.uint64(MASK) == 0


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _hidden(p: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = p["bias"] + p["places"][0][codes[at + WINDOW[0]]]
    for k in range(1, len(WINDOW)):
        h += p["places"][k][codes[at + WINDOW[k]]]
    return (np.tanh(h, out=h), *np.divmod(codes[at], len(p["upper_bias"])))


def forward(p: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray):
    """(hidden, log P of upper bits, log P of lower bits given the upper ones, upper, lower)."""
    h, up, low = _hidden(p, codes, at)
    lu = _log_softmax(h @ p["upper"] + p["upper_bias"])
    ll = _log_softmax((h * p["gate"][up]) @ p["lower"] + p["lower_bias"][up])
    return h, lu, ll, up, low


def _chosen(x: np.ndarray, rows: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Log-softmax of each row at one place; ``x`` is used up."""
    top = x.max(axis=1)
    at = x[rows, which] - top
    x -= top[:, None]
    return at - np.log(np.exp(x, out=x).sum(axis=1))


def log_probabilities(p: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P(token | window) at the positions ``at``."""
    out = np.empty(len(at))
    for i in range(0, len(at), 8192):
        part = at[i : i + 8192]
        h, up, low = _hidden(p, codes, part)
        rows = np.arange(len(part))
        out[i : i + 8192] = _chosen(h @ p["upper"] + p["upper_bias"], rows, up)
        out[i : i + 8192] += _chosen((h * p["gate"][up]) @ p["lower"] + p["lower_bias"][up], rows, low)
    return out


def _slopes(p: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray):
    """Gradient of the mean negative log-probability at ``at``: by name, and per
    window place the codes that occur there with their rows."""
    h, lu, ll, up, low = forward(p, codes, at)
    rows, n = np.arange(len(at)), np.float32(len(at))
    v = {}
    du, dl = np.exp(lu), np.exp(ll)
    du[rows, up] -= 1
    dl[rows, low] -= 1
    du /= n
    dl /= n
    gated = h * p["gate"][up]
    v["upper"] = h.T @ du
    v["upper_bias"] = du.sum(axis=0)
    v["lower"] = gated.T @ dl
    back = dl @ p["lower"].T
    one_hot = np.zeros((len(at), len(p["upper_bias"])), dtype=np.float32)
    one_hot[rows, up] = 1
    v["lower_bias"] = one_hot.T @ dl
    v["gate"] = one_hot.T @ (back * h)
    dh = (du @ p["upper"].T + back * p["gate"][up]) * (1 - h * h)
    v["bias"] = dh.sum(axis=0)
    places = []
    for off in WINDOW:
        where = codes[at + off]
        order = np.argsort(where, kind="stable")
        names, first = np.unique(where[order], return_index=True)
        places.append((names, np.add.reduceat(dh[order], first, axis=0)))
    return v, places


def gradient(p: dict[str, np.ndarray], codes: np.ndarray, at: np.ndarray, flat_size: int) -> np.ndarray:
    """Gradient of the mean negative log-probability at ``at``."""
    g = np.zeros(flat_size, dtype=np.float32)
    out = unflatten(g)
    v, places = _slopes(p, codes, at)
    for name, slope in v.items():
        out[name][:] = slope
    for k, (names, slope) in enumerate(places):
        out["places"][k][names] = slope
    return g


def _train(codes: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch], flat: np.ndarray) -> tuple[float, np.ndarray]:
        p = unflatten(flat)
        words = Words(codes, len(p["upper_bias"]) ** 2)
        square = unflatten(np.full(len(flat), 1e-6, dtype=np.float32))
        done = 0
        for batch in batches:
            numbers, lengths = words.numbered(batch.column(0))
            text, at = words.codes(numbers), np.flatnonzero(numbers)
            masked = at[_masked(text[at], lengths)]
            for i in range(0, len(masked), MINIBATCH):
                v, places = _slopes(p, text, masked[i : i + MINIBATCH])
                for name, g in v.items():
                    square[name] += g * g
                    p[name] -= np.float32(STEP) * g / np.sqrt(square[name])
                for k, (names, g) in enumerate(places):  # only the codes that occur
                    square["places"][k][names] += g * g
                    p["places"][k][names] -= np.float32(STEP) * g / np.sqrt(square["places"][k][names])
            done += len(at)
        return float(done), flat

    return work


def train(docs: DataFrame, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Parameters of the network, trained on all documents."""
    prepare(docs.sparkSession)
    return train_averaged(docs.select("text"), initial(counts), _train(codes))


def _with_means(scored: DataFrame) -> DataFrame:
    mean = F.when(F.col("n_tokens") > 0, F.col("pll") / F.col("n_tokens"))
    return scored.withColumn("mean_pll", mean).withColumn("pseudo_perplexity", F.exp(-F.col("mean_pll")))


def score(docs: DataFrame, codes: np.ndarray, flat: np.ndarray) -> DataFrame:
    """Per row: doc_id, n_tokens, pll (sum), mean_pll, pseudo_perplexity, of the codes alone."""
    return _with_means(_score(docs, codes, flat, None, {}).select("doc_id", "n_tokens", "pll"))


def _score(docs: DataFrame, codes: np.ndarray, flat: np.ndarray, counts: np.ndarray | None, head: dict[str, int]) -> DataFrame:
    """Per row: doc_id, n_tokens, pll, rest. With the codes' ``counts``, pll holds
    log P(code | window) - log (n(code) + 1) of every token and log n(word) of the
    words in ``head``; ``rest`` are the tokens whose log n(word) is still to add."""
    codes = codes.astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = unflatten(flat)
        words = Words(codes, len(p["upper_bias"]) ** 2, head)
        base = None if counts is None else np.log(counts + 1.0)
        for batch in batches:
            numbers, lengths = words.numbered(batch.column(1))
            text, at = words.codes(numbers), np.flatnonzero(numbers)
            each = log_probabilities(p, text, at)
            rest: list[list[str]] = [[]] * len(lengths)
            if base is not None:
                tokens = numbers[at]
                known = words.logs(tokens)
                rare = np.flatnonzero(np.isnan(known))
                known[rare] = 0.0
                each += known - base[text[at]]
                names = [words.names[k] for k in tokens[rare].tolist()]
                cuts = np.searchsorted(rare, np.cumsum(lengths)).tolist()
                rest = [names[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
            sums = np.concatenate([[0.0], np.cumsum(each)])
            ends = np.cumsum(lengths)
            total = sums[ends] - sums[ends - lengths]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), pa.array(total), pa.array(rest, pa.list_(pa.string()))], names=["doc_id", "n_tokens", "pll", "rest"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, n_tokens long, pll double, rest array<string>")


def score_words(docs: DataFrame, codes: np.ndarray, flat: np.ndarray, words: DataFrame, counts: np.ndarray, head: int = HEAD) -> DataFrame:
    """As ``score``, of the words: P(code | window) * P(word | code) by the word table."""
    part = _score(docs, codes, flat, counts, frequent_words(words, head))
    part = land(part.withColumn("row", F.monotonically_increasing_id()), "code_scores")
    tokens = part.select("row", F.explode("rest").alias("word"))
    logs = tokens.join(words, "word", "left").groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(1)))).alias("more"))
    whole = part.drop("rest").join(logs, "row", "left")
    return _with_means(whole.select("doc_id", "n_tokens", (F.col("pll") + F.coalesce("more", F.lit(0.0))).alias("pll")))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Count, train and score over all documents."""
    words = word_table(docs)
    codes, counts = code_table(docs, words)
    return score_words(docs, codes, train(docs, codes, counts), words, counts)
