"""BPE encoding with reuse of content-defined chunks (operator 6).

1. A rolling hash over the text's bytes cuts it where the last 16 bytes say so,
   so equal passages are cut alike in all documents. Documents travel in
   batches of a few MB; a batch names each distinct chunk once and sends it, by
   chunk hash, to one partition.
2. There every distinct chunk of the whole corpus is encoded once (as long as
   the results of a partition fit in ``KNOWN_BYTES``): its head
   (up to the first white space), its body, and its tail (after the last white
   space) apart, since head and tail may be parts of words.
3. The results go back to the batches. Where two chunks meet, the window of the
   left one's tail and the right one's head is encoded anew; a chunk without
   white space only widens the window, until white space bounds it on both
   sides, where the ids agree with those of the whole text.

A chunk that many documents share crosses the network once per batch, not once
per document. Defined results: a NULL or empty text has no ids; repeated rows
give repeated result rows; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import parallelism, prepare

#: A chunk ends, on average, every 2 ** CUT_BITS bytes past its least size.
CUT_BITS = 9
MIN_CHUNK = 512
BATCH_BYTES = 16_000_000
#: Results that a task remembers, in bytes with what Python needs for each.
KNOWN_BYTES = 400_000_000
_ROUTED = "part long, batch long, blob binary"

_GEAR = np.random.default_rng(20_090_401).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLANKS = " \t\n\r\x0b\x0c"


def cuts(data: bytes) -> list[int]:
    """End offsets of the chunks of UTF-8 bytes; never inside a character."""
    if not data:
        return []
    b = np.frombuffer(data, dtype=np.uint8)
    h = _GEAR[b]
    for k in (1, 2, 4, 8):  # doubling: afterwards h depends on the last 16 bytes
        more = h.copy()
        more[k:] += h[:-k] << np.uint32(k) if len(h) > k else np.uint32(0)
        h = more
    stop = (h >> np.uint32(32 - CUT_BITS)) == 0
    stop[:-1] &= (b[1:] & 0xC0) != 0x80
    ends, last = [], 0
    for i in (np.flatnonzero(stop) + 1).tolist():
        if i - last >= MIN_CHUNK and i < len(b):
            ends.append(i)
            last = i
    return [*ends, len(b)]


def _pack(parts: list[bytes]) -> bytes:
    import zstandard

    sizes = np.array([len(parts), *map(len, parts)], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=6).compress(sizes + b"".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int.from_bytes(data[:4], "little")
    ends = np.cumsum(np.frombuffer(data, dtype="<u4", count=n, offset=4), dtype=np.int64) + 4 * (n + 1)
    starts = [4 * (n + 1), *ends[:-1].tolist()] if n else []
    return [data[i:j] for i, j in zip(starts, ends.tolist())]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    parts, batches, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(batches, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "batch", "blob"]
    )


def _cut_batches(partitions: int):
    """Documents -> chunk blobs by partition, and each batch's layout (its
    documents as lists of chunk places) under partition -1 - home."""

    def flush(number: int, docs: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
        from pyspark import TaskContext
        from xxhash import xxh3_64_intdigest

        batch = (TaskContext.get().partitionId() << 32) + number
        chunks: list[list[bytes]] = [[] for _ in range(partitions)]
        place: dict[bytes, tuple[int, int]] = {}
        layout, lengths, ids = [], [], []
        for doc, data in docs:
            at = 0
            ends = cuts(data)
            for end in ends:
                chunk = data[at:end]
                at = end
                if chunk not in place:
                    p = xxh3_64_intdigest(chunk) % partitions
                    place[chunk] = (p, len(chunks[p]))
                    chunks[p].append(chunk)
                layout.append(place[chunk])
            lengths.append(len(ends))
            ids.append(doc)
        plan = [
            np.array(layout, dtype="<i8").tobytes(),
            np.array(lengths, dtype="<i8").tobytes(),
            np.array([d or 0 for d in ids], dtype="<i8").tobytes(),
            np.array([d is None for d in ids], dtype="?").tobytes(),
        ]
        rows = [(p, batch, _pack(c)) for p, c in enumerate(chunks) if c]
        return _rows([*rows, (-1 - batch % partitions, batch, _pack(plan))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int | None, bytes]] = []
        held = number = 0
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                data = (text.as_py() or "").encode()
                docs.append((doc.as_py(), data))
                held += len(data) + 64
                if held >= BATCH_BYTES:
                    yield flush(number, docs)
                    docs, held, number = [], 0, number + 1
        if docs:
            yield flush(number, docs)

    return run


def split_chunk(text: str) -> tuple[str, str | None, str]:
    """(head, body, tail); without white space the body is None and the head is all."""
    first = next((i for i, c in enumerate(text) if c in _BLANKS), -1)
    if first < 0:
        return text, None, ""
    last = max(map(text.rfind, _BLANKS))
    return text[:first], text[first : last + 1], text[last + 1 :]


def _encode_once(path: str, known_bytes: int = KNOWN_BYTES):
    """Chunk blobs -> result blobs. A partition sees every copy of its chunks,
    so each distinct chunk is encoded once. Results are remembered by a 128-bit
    digest of the chunk; past ``known_bytes`` they are forgotten before the next
    batch, whose chunks are then encoded anew, to the same ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        from boxstar.llm.wordbpe import encoder

        enc = encoder(path)
        known: dict[bytes, bytes] = {}
        held = 0
        for b in batches:
            for part, batch, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if part < 0:
                    yield _rows([(part, batch, blob.as_py())])
                    continue
                chunks = _unpack(blob.as_py())
                if held > known_bytes:
                    known.clear()
                    held = 0
                names = [xxh3_128_digest(c) for c in chunks]
                new = {k: c for k, c in zip(names, chunks) if k not in known}
                cut = [split_chunk(c.decode()) for c in new.values()]
                bodies = enc.ids_many([body or "" for _, body, _ in cut])
                for k, (head, body, tail), ids in zip(new, cut, bodies):
                    head_b, tail_b = head.encode(), tail.encode()
                    small = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()
                    flags = np.array([len(head_b), len(tail_b), body is not None], dtype="<u4").tobytes()
                    known[k] = flags + head_b + tail_b + small
                    held += len(known[k]) + 200
                yield _rows([(part, batch, _pack([known[k] for k in names]))])

    return run


def _open(record: bytes) -> tuple[str, str, bool, bytes]:
    h, t, bounded = np.frombuffer(record, dtype="<u4", count=3).tolist()
    return record[12 : 12 + h].decode(), record[12 + h : 12 + h + t].decode(), bool(bounded), record[12 + h + t :]


def join_chunks(records: list[tuple[str, str, bool, bytes]]) -> list[bytes | str]:
    """Ids of bounded stretches (bytes), and between them the texts to encode anew."""
    out: list[bytes | str] = []
    window = ""
    for head, tail, bounded, ids in records:
        if bounded:
            out += [window + head, ids]
            window = tail
        else:
            window += head
    return [*out, window]


def _assemble(path: str):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        from boxstar.llm.wordbpe import encoder

        enc = encoder(path)
        words = _strings(path, enc)
        parts = {p: blob for p, blob in zip(table["part"].to_pylist(), table["blob"])}
        home = next(p for p in parts if p < 0)
        layout, lengths, ids, missing = _unpack(parts.pop(home).as_py())
        layout = np.frombuffer(layout, dtype="<i8").reshape(-1, 2).tolist()
        lengths = np.frombuffer(lengths, dtype="<i8").tolist()
        ids = np.frombuffer(ids, dtype="<i8").tolist()
        missing = np.frombuffer(missing, dtype="?").tolist()
        opened = {p: [_open(r) for r in _unpack(blob.as_py())] for p, blob in parts.items()}
        ends = np.cumsum(lengths).tolist()
        pieces = [join_chunks([opened[p][i] for p, i in layout[e - n : e]]) for n, e in zip(lengths, ends)]
        windows = iter(enc.ids_many([x for doc in pieces for x in doc if isinstance(x, str)]))
        decimal, token = words
        rows = []
        for doc, null, parts_of in zip(ids, missing, pieces):
            whole = b"".join([next(windows) if isinstance(x, str) else _wide(x) for x in parts_of])
            numbers = np.frombuffer(whole, dtype="<u4").tolist()
            rows.append((
                None if null else doc,
                len(numbers),
                hashlib.sha256(" ".join([decimal[i] for i in numbers]).encode()).hexdigest(),
                hashlib.sha256(" ".join([token[i] for i in numbers]).encode()).hexdigest(),
            ))
        cols = list(zip(*rows)) if rows else [[]] * 4
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _wide(ids: bytes) -> bytes:
    return np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


_words: dict[str, tuple[list[str], list[str]]] = {}


def _strings(path: str, enc) -> tuple[list[str], list[str]]:
    """Per id: its decimal form, and its token (the vocabulary has no decoder,
    so the library decodes by joining tokens with one space)."""
    if path not in _words:
        n = max(enc.token_of) + 1
        _words[path] = [str(i) for i in range(n)], [enc.token_of.get(i, "") for i in range(n)]
    return _words[path]


def encode_documents(docs: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256. ``partitions`` deal the chunks
    (the session's shuffle partitions if not given; about one for each GB of text, at least,
    keeps the results of each in memory)."""
    spark = docs.sparkSession
    prepare(spark)
    parts = partitions or parallelism(spark)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    sent = narrow.mapInArrow(_cut_batches(parts), _ROUTED).repartition(parts, "part")
    encoded = sent.mapInArrow(_encode_once(path), _ROUTED)
    return encoded.groupBy("batch").applyInArrow(
        _assemble(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
