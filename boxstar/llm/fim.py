"""Fill-in-middle transformation with a sparse exception index.

A text is cut into prefix, middle and suffix. Cuts may be asked for in tokens,
code points or bytes; texts are UTF-8, so the three differ only where characters
take several bytes. :class:`Exceptions` records nothing else: the positions of the
multibyte characters of a batch of texts and the bytes that each one has beyond
the first. A ``searchsorted`` into these positions tells how many extra bytes lie
before a cut; everything between two exceptions is plain arithmetic, and a batch of
ASCII texts has an empty index.

Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: a run of other
characters with the blanks before it, or blanks at the end of the text. They are found
in the bytes of a whole Arrow batch at once; a batch is the unit of memory.

A document's draws come from the SHA-256 of ``seed:doc_id``, so they do not depend on
partitions or on a task that runs again.

Defined cases: a NULL text is empty; an empty text is plain with n 0; a NULL doc_id
draws as the empty string and stays NULL; rows with the same id draw alike; repeated
rows stay repeated; further columns of the input are left out; an empty table gives
an empty result. Texts are never truncated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxstar.llm.common import prepare

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in per cent: documents that are transformed, and of those the suffix-first ones.
RATE, SPM_RATE = 50, 80
SEED = 42

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, "
    "output string"
)


class Exceptions:
    """Multibyte characters of UTF-8 ``data``: where they start, and their bytes
    beyond the first, summed up."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.total = np.concatenate([[0], np.cumsum(excess)])
        self.at_char = self.at - self.total[:-1]

    def to_chars(self, offsets: np.ndarray) -> np.ndarray:
        """Code points before byte ``offsets`` (which lie between characters)."""
        return offsets - self.total[np.searchsorted(self.at, offsets, side="left")]

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte offsets of code points ``chars``."""
        return chars + self.total[np.searchsorted(self.at_char, chars, side="left")]


class Batch:
    """Texts of one Arrow batch: their bytes, offsets, exception index and tokens."""

    def __init__(self, texts: pa.Array):
        texts = pa.concat_arrays([texts.cast(pa.large_binary()).fill_null(b"")])
        _, offsets, data = texts.buffers()
        self.starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        size = int(self.starts[-1])
        self.data = np.frombuffer(data, dtype=np.uint8)[:size] if data is not None and size else np.zeros(0, np.uint8)
        self.raw = memoryview(self.data)
        self.index = Exceptions(self.data)

    def token_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets at which tokens end, and how many of them lie before each text."""
        blank = np.append(_BLANK[self.data], True)
        last = np.zeros(len(self.data) + 1, dtype=bool)  # the byte before this one ends a text
        ends_of_texts = self.starts[1:][np.diff(self.starts) > 0]
        last[ends_of_texts] = True
        ends = np.flatnonzero((~blank[:-1] & blank[1:]) | last[1:]) + 1
        return ends, np.searchsorted(ends, self.starts, side="right")

    def piece(self, start: int, end: int) -> bytes:
        return bytes(self.raw[start:end])


def draws(ids: list[int | None], seed: int = SEED) -> np.ndarray:
    """Four 32-bit draws for each id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, dtype=">u4").reshape(-1, 4).astype(np.int64)


def cuts(batch: Batch, drawn: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(units of each text, byte offset where its prefix ends, where its middle ends)."""
    starts, ends = batch.starts[:-1], batch.starts[1:]
    if unit == "token":
        marks, before = batch.token_ends()
        n = np.diff(before)
    elif unit == "char":
        first = batch.index.to_chars(starts)
        n = batch.index.to_chars(ends) - first
    else:
        raise ValueError(f"no such unit: {unit}")
    low, high = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1).T
    if unit == "char":
        return n, batch.index.to_bytes(first + low), batch.index.to_bytes(first + high)
    marks = np.append(marks, 0)

    def ending(count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, marks[np.maximum(before[:-1] + count - 1, 0)], starts)

    return n, ending(low), ending(high)


def transform(ids: list[int | None], texts: pa.Array, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, unit: str = "token") -> dict:
    """The columns after ``doc_id`` of :data:`SCHEMA` for one batch."""
    batch, drawn = Batch(texts), draws(ids, seed)
    n, low, high = cuts(batch, drawn, unit)
    starts, ends = batch.starts[:-1], batch.starts[1:]
    first = batch.index.to_chars(starts)
    prefix_chars, middle_chars = batch.index.to_chars(low) - first, batch.index.to_chars(high) - batch.index.to_chars(low)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    forms, outputs = [], []
    for k in range(len(ids)):
        a, b, c, d = (int(x[k]) for x in (starts, low, high, ends))
        whole = batch.piece(a, d)
        if not whole or drawn[k, 2] % 100 >= rate or any(x in whole for x in (p, s, m)):
            forms.append("plain")
            outputs.append(whole)
            continue
        prefix, middle, suffix = whole[: b - a], whole[b - a : c - a], whole[c - a :]
        if drawn[k, 3] % 100 < spm_rate:
            forms.append("spm")
            outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    spans = {"prefix_chars": prefix_chars, "middle_chars": middle_chars, "prefix_bytes": low - starts, "middle_bytes": high - low}
    return {
        "n": pa.array(n, pa.int64()),
        "form": pa.array(forms, pa.string()),
        **{k: pa.array(v, pa.int64(), mask=plain) for k, v in spans.items()},
        "output": pa.array(outputs, pa.large_binary()),
    }


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, unit: str = "token") -> DataFrame:
    """Per row of ``docs``: doc_id, n (units), form (plain, psm, spm), the lengths of prefix
    and middle in code points and bytes (NULL if plain), and the output."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            out = transform(ids.to_pylist(), texts, seed, rate, spm_rate, unit)
            out["output"] = out["output"].cast(pa.large_string(), safe=False).cast(pa.string())
            yield pa.RecordBatch.from_pydict({"doc_id": ids, **out}).select([c.split()[0] for c in SCHEMA.split(", ")])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text, from the output and its form alone. Sentinels cannot overlap each other
    or text next to them, so the first of each kind is the real one."""
    head = F.substring_index(output, MIDDLE, 1)  # all before the middle
    middle = F.substring(output, F.length(head) + F.lit(1 + len(MIDDLE)), F.length(output))

    def halves(second: str) -> tuple[Column, Column]:
        one = F.substring_index(head, second, 1)
        two = F.substring(head, F.length(one) + F.lit(1 + len(second)), F.length(head))
        return F.substring(one, F.lit(1 + len(PREFIX)), F.length(one)), two

    prefix, suffix = halves(SUFFIX)
    late_suffix, late_prefix = halves(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(late_prefix, middle, late_suffix))
        .otherwise(output)
    )


def transform_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


#: The whole of ``transform_documents`` over ``documents``.
ORACLE_SQL = r"""
WITH base AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
    FROM documents
), drawn AS (
    SELECT doc_id, text, tokens, len(tokens) AS n,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(tokens) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(tokens) + 1) AS c2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS d3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d4
    FROM base
), cut AS (
    SELECT doc_id, text, n,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d3 >= 50 THEN 'plain'
                WHEN d4 < 80 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(tokens[1:least(c1, c2)], '') AS prefix,
           array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
           array_to_string(tokens[greatest(c1, c2) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
