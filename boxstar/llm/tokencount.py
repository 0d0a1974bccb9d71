"""Token counts by a finite-state transducer (operator 5).

The byte-level BPE tokenizer is compiled into one deterministic transducer over
characters. Each transition carries the change of the token count, so the
count of a text is the sum along its path. A state holds

* where the pre-tokenizer's pattern stands (letters, numbers, other signs,
  white space, an apostrophe that may open a contraction), and
* the BPE automaton's state in the open pre-token: the longest suffix that
  starts some vocabulary token, and for each position in it the last token and
  the count (relative to now) that the text up to there would have.

The BPE part rests on a property of merge tokenizers: tokens form the encoding
of their text exactly when every two neighbours encode to themselves, so the
last token of each prefix is the one suffix token that fits its predecessor.
The window of a state is as long as the longest vocabulary token at most, so
states are finite; they are made when first met and dropped when their number
passes ``MAX_STATES`` (results do not depend on it).

A text is cut into chunks of fixed length. A chunk's state map is short:
whatever state enters, a white-space character after another character leads
to one known state, so the map is (characters up to there, count from there to
the end, state at the end). Maps compose associatively; a balanced prefix scan
folds a text's maps. Chunks without such a place compose by running through.

Special-token strings inside a text count one token each and cut it, as the
library does. Defined results: a NULL or empty text has 0 bytes and 0 tokens;
repeated rows give repeated result rows; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import prepare
from boxstar.llm.wordbpe import _byte_of_char

LIMIT = 1024
CHUNK = 8192
MAX_STATES = 500_000

_cache: dict[str, "CountTransducer"] = {}


def transducer(path: str) -> "CountTransducer":
    """The worker's transducer for a vocabulary file."""
    if path not in _cache:
        _cache[path] = CountTransducer(path)
    return _cache[path]


class ByteNode:
    """BPE automaton state: the window of bytes and, for each place in it where a
    longer token may have begun, furthest first: (bytes back, last token before the
    place, count there relative to now). Token -1: start of the pre-token."""

    __slots__ = ("past", "window")

    def __init__(self, window: bytes, past: tuple[tuple[int, int, int], ...]):
        self.window, self.past = window, past


class State(dict):
    """Transducer state: character -> (next state, change of the count)."""

    __slots__ = ("gain", "kind", "machine", "node", "sign")

    def __init__(self, machine: "CountTransducer", kind: str, node: ByteNode | None, gain: int, sign: str):
        self.machine, self.kind, self.node, self.gain, self.sign = machine, kind, node, gain, sign

    def __missing__(self, ch: str):
        step = self.machine.advance(self, ch)
        self[ch] = step
        return step


class CountTransducer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        back = _byte_of_char()
        self.raw = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.raw.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        merges = [tuple(bytes(back[c] for c in side) for side in m) for m in pairs]
        self.ranks = {pair: r for r, pair in reversed(list(enumerate(merges)))}
        self.prefixes = {b[:k] for b in self.raw for k in range(1, len(b))}  # of longer tokens
        self.longest = max(map(len, self.raw))
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.kinds: dict[str, str] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states made so far."""
        self.nodes: dict[tuple[bytes, tuple], ByteNode] = {}
        self.states: dict[tuple, State] = {}
        self.root = ByteNode(b"", ((0, -1, 0),))
        self.start = self._state("start", None, 0, "")

    def _state(self, kind: str, node: ByteNode | None, gain: int, sign: str) -> State:
        key = (kind, id(node), gain, sign)
        if key not in self.states:
            self.states[key] = State(self, kind, node, gain, sign)
        return self.states[key]

    # -- the BPE part ---------------------------------------------------------
    def merged(self, data: bytes) -> list[bytes]:
        """BPE of a short byte string, merge by merge."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get((a, b), 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow token ``a`` (-1: the start) in an encoding."""
        key = (a, b)
        if key not in self.fits:
            left = self.bytes_of[a] if a >= 0 else b""
            right = self.bytes_of[b]
            self.fits[key] = self.merged(left + right) == ([left, right] if a >= 0 else [right])
        return self.fits[key]

    def read_byte(self, node: ByteNode, byte: int) -> tuple[ByteNode, int]:
        """Next BPE state and the change of the open pre-token's count."""
        seen = node.window + bytes((byte,))
        for k, last, count in node.past:
            token = self.raw.get(seen[-k - 1 :])
            if token is not None and self.neighbours(last, token):
                break
        else:
            raise ValueError("byte without a token")
        gain = count + 1
        prefixes = self.prefixes
        start = max(0, len(seen) - self.longest)
        while start < len(seen) and seen[start:] not in prefixes:
            start += 1
        window = seen[start:]
        # keep the places from which some longer token may still start
        kept = [(k + 1, t, c - gain) for k, t, c in node.past if k < len(window) and window[-k - 1 :] in prefixes]
        past = (*kept, (0, token, 0))
        known = self.nodes.get((window, past))
        if known is None:
            known = self.nodes[window, past] = ByteNode(window, past)
        return known, gain

    def read(self, node: ByteNode, ch: str) -> tuple[ByteNode, int]:
        total = 0
        for byte in ch.encode("utf-8", "replace"):
            node, gain = self.read_byte(node, byte)
            total += gain
        return node, total

    # -- the pre-tokenizer's pattern -------------------------------------------
    def kind_of(self, ch: str) -> str:
        """L letter, N number, S white space, O other: as the library's own pattern takes it."""
        if ch not in self.kinds:
            pieces = self.library.pre_tokenizer.pre_tokenize_str
            one = {"L": f"a{ch}a", "N": f"1{ch}1", "O": f"!{ch}!"}
            self.kinds[ch] = next((k for k, probe in one.items() if len(pieces(probe)) == 1), "S")
        return self.kinds[ch]

    def opened(self, ch: str) -> tuple[State, int]:
        """State and count of a new pre-token that begins with ``ch``."""
        kind = self.kind_of(ch)
        node, gain = self.read(self.root, ch)
        if kind == "S":
            return self._state("S", node, gain, ch), gain
        return self._state("'" if ch == "'" else kind, node, 0, ""), gain

    def advance(self, state: State, ch: str) -> tuple[State, int]:
        """One transition: the next state and the change of the count."""
        kind = self.kind_of(ch)
        now = state.kind
        if now == "'":  # an apostrophe that opens its pre-token
            if ch in "stmd":
                node, gain = self.read(state.node, ch)
                return self._state("closed", None, 0, ""), gain
            if ch in "rvl":
                node, gain = self.read(self.root, ch)
                return self._state("'" + ch, node, gain, ""), gain
            if kind == "O":
                node, gain = self.read(state.node, ch)
                return self._state("O", node, 0, ""), gain
            return self.opened(ch)
        if now in ("'r", "'v", "'l"):
            if ch == ("l" if now == "'l" else "e"):  # the contraction after all
                node, _ = self.read(self.root, "'")
                node, more = self.read(node, now[1])
                node, last = self.read(node, ch)
                return self._state("closed", None, 0, ""), more + last - state.gain
            now = "L"
        if now == "S":
            if kind == "S":
                node, gain = self.read(state.node, ch)
                return self._state("S", node, gain, ch), gain
            # the run's last character leaves it: a blank joins what follows, others stand alone
            if state.sign == " ":
                node, _ = self.read(self.root, " ")
                alone = self.read(self.root, " ")[1]
                node, gain = self.read(node, ch)
                return self._state(kind, node, 0, ""), alone + gain - state.gain
            alone = self.read(self.root, state.sign)[1]
            follow, gain = self.opened(ch)
            return follow, alone + gain - state.gain
        if now == kind and kind in "LNO":
            node, gain = self.read(state.node, ch)
            return self._state(kind, node, 0, ""), gain
        return self.opened(ch)

    # -- chunks ------------------------------------------------------------------
    def run(self, state: State, text: str) -> tuple[State, int]:
        """End state and change of the count along ``text``."""
        total = 0
        for ch in text:
            state, gain = state[ch]
            total += gain
        return state, total

    def chunk_map(self, chunk: str) -> tuple[str, State | None, int]:
        """(head, end state, count after the head). Every entering state leads
        to the same state after the head; without such a place the head is the
        whole chunk and there is no end state yet."""
        place = _SYNC.search(chunk)
        if not place or self.kind_of(chunk[place.end() - 1]) != "S" or self.kind_of(chunk[place.start()]) == "S":
            return chunk, None, 0
        known, _ = self.opened(chunk[place.end() - 1])
        end, count = self.run(known, chunk[place.end() :])
        return chunk[: place.end()], end, count

    def compose(self, f, g):
        """The map of two neighbouring chunks (associative)."""
        if f[1] is None:
            return f[0] + g[0], g[1], g[2]
        state, count = self.run(f[1], g[0])
        return f[0], (state if g[1] is None else g[1]), f[2] + count + g[2]

    def count_plain(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a text without special-token strings."""
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:  # up the tree of the prefix scan
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        if not maps:
            return 0
        head, _, count = maps[0]
        return self.run(self.start, head)[1] + count

    def count(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text, as the library counts them."""
        if len(self.states) + len(self.nodes) > MAX_STATES:
            self.reset()
        if self.special is None:
            return self.count_plain(text, chunk)
        parts = self.special.split(text)
        return sum(self.count_plain(p, chunk) for p in parts) + len(parts) - 1


#: A character that is no white space, then ASCII white space.
_SYNC = re.compile(r"\S[ \t\n\r]")


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            counts = [machine.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = narrow.mapInArrow(_counts(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
