"""Token counts of whole texts without the ids: pieces are counted once per distinct pre-token.

Texts are taken in chunks of CHUNK documents. A task counts the pre-tokens of a chunk and hands on one row for each
distinct pre-token of it, with the documents and their frequencies packed in three bytes each. The rows meet by
pre-token: a partition is sorted, so each distinct pre-token is counted once and multiplied into the frequencies of
all documents. The sums of a chunk's documents travel as one vector. Pre-tokens that are one piece as they stand, which
the fixed vocabulary tells, are summed before anything moves; they are the most frequent ones.
"""

from __future__ import annotations

import os
from collections import defaultdict
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import ship_code

#: Documents of a chunk; their places fit into two bytes.
CHUNK = 4096
#: A chunk also ends after so many characters.
CHUNK_CHARS = 8 << 20
LIMIT = 1024
#: A task hands on its sums when it holds so many chunks.
HELD_CHUNKS = 2000

ROWS = "token string, chunk long, payload binary, head boolean"
SUMS = "chunk long, kind int, payload binary"
COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: The split of byte-level BPE, with white space named by its Unicode property.
_SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


@lru_cache(maxsize=1)
def _tools(path: str):
    """The tokenizer, its pre-token pattern, its special strings, and the pre-tokens that are one piece."""
    import regex
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    entries = list(tokenizer.get_vocab(with_added_tokens=False))
    texts = [tokenizer.decoder.decode([entry]) for entry in entries]
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    single = {text for text, found in zip(texts, encoded) if len(found.ids) == 1 and "�" not in text}
    around = regex.compile("|".join(map(regex.escape, special))) if special else None
    return tokenizer, regex.compile(_SPLIT), around, single


def _frequencies(path: str):
    def counted(batches):
        _, split, around, single = _tools(path)
        chunk = TaskContext.get().partitionId() << 32
        places: dict = defaultdict(count().__next__)
        docs, chars = [], 0
        keys = []

        def close():
            yield from _rows(chunk, places, docs, keys)

        for batch in batches:
            lengths = pa.compute.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for doc_id, text, n_bytes in zip(batch.column(0).to_pylist(), batch.column(1), lengths):
                text = text.as_py() or ""
                parts = around.split(text) if around else [text]
                tokens = split.findall(parts[0]) if len(parts) == 1 else [t for part in parts for t in split.findall(part)]
                rest = [t for t in tokens if t not in single]
                found = np.fromiter(map(places.__getitem__, rest), dtype=np.int64, count=len(rest))
                keys.append(found * CHUNK + len(docs))
                docs.append((doc_id, n_bytes, len(parts) - 1 + len(tokens) - len(rest)))
                chars += len(text)
                if len(docs) == CHUNK or chars > CHUNK_CHARS:
                    yield from close()
                    chunk += 1
                    places, docs, keys, chars = defaultdict(count().__next__), [], [], 0
        if docs:
            yield from close()

    return counted


def _rows(chunk, places, docs, keys):
    """A row for the chunk's documents, and one for each pre-token: places (two bytes) and frequencies (one byte)."""
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    full, part = np.divmod(times - 1, 255)
    # A frequency over 255 is several entries: full ones, and the rest in 1..255.
    key = np.concatenate([key, np.repeat(key, full)])
    times = np.concatenate([part + 1, np.full(int(full.sum()), 255)])
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    token, place = np.divmod(key, CHUNK)
    entries = np.empty((len(key), 3), dtype=np.uint8)
    entries[:, 0], entries[:, 1], entries[:, 2] = place & 255, place >> 8, times
    ends = 3 * np.searchsorted(token, np.arange(len(places)), "right")
    payload = pa.BinaryArray.from_buffers(
        pa.binary(), len(places), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(entries.tobytes())]
    )
    head = np.array([(i or 0, i is None, n, k) for i, n, k in docs], dtype="<i8")
    yield _row_batch([f"chunk {chunk}"], [chunk], pa.array([head.tobytes()], pa.binary()), True)
    tokens = list(places)
    for at in range(0, len(tokens), 50_000):
        some = tokens[at : at + 50_000]
        yield _row_batch(some, [chunk] * len(some), payload.slice(at, len(some)), False)


def _row_batch(tokens, chunks, payload, head):
    return pa.RecordBatch.from_arrays(
        [pa.array(tokens, pa.string()), pa.array(chunks, pa.int64()), payload, pa.array([head] * len(tokens))],
        names=["token", "chunk", "payload", "head"],
    )


def _sums(kind, chunks, payloads):
    return pa.RecordBatch.from_arrays(
        [pa.array(chunks, pa.int64()), pa.array([kind] * len(chunks), pa.int32()), pa.array(payloads, pa.binary())],
        names=["chunk", "kind", "payload"],
    )


def _multiply(path: str):
    """From rows sorted by token: the rows of chunks as they are (kind 0), and vectors of sums (kind 1)."""

    def multiplied(batches):
        tokenizer = _tools(path)[0]
        held: dict[int, np.ndarray] = {}
        last, pieces = None, 0
        for batch in batches:
            heads = batch.filter(batch.column(3))
            if len(heads):
                yield _sums(0, heads.column(1).to_pylist(), heads.column(2).to_pylist())
            batch = batch.filter(pa.compute.invert(batch.column(3)))
            if not len(batch):
                continue
            tokens = batch.column(0).to_pylist()
            fresh = np.array([t != before for t, before in zip(tokens, [last, *tokens])])
            new = [t for t, is_fresh in zip(tokens, fresh) if is_fresh]
            counts = [pieces, *(len(found.ids) for found in tokenizer.encode_batch_fast(new, add_special_tokens=False))]
            last, pieces = tokens[-1], counts[-1]
            per_row = np.array(counts)[np.cumsum(fresh)]
            chunks, which = np.unique(batch.column(1).to_numpy(), return_inverse=True)
            payload = batch.column(2).to_pylist()
            entries = np.frombuffer(b"".join(payload), dtype=np.uint8).reshape(-1, 3).astype(np.int64)
            times = np.array([len(x) // 3 for x in payload])
            key = np.repeat(which, times) * CHUNK + entries[:, 0] + 256 * entries[:, 1]
            key, at = np.unique(key, return_inverse=True)
            total = np.bincount(at, weights=np.repeat(per_row, times) * entries[:, 2]).astype(np.int64)
            edges = np.searchsorted(key, np.arange(len(chunks) + 1) * CHUNK)
            for i, chunk in enumerate(chunks.tolist()):
                if chunk not in held:
                    if len(held) == HELD_CHUNKS:
                        yield _sums(1, list(held), [v.tobytes() for v in held.values()])
                        held.clear()
                    held[chunk] = np.zeros(CHUNK, dtype="<u4")
                some = slice(edges[i], edges[i + 1])
                held[chunk][key[some] - i * CHUNK] += total[some].astype(np.uint32)
        if held:
            yield _sums(1, list(held), [v.tobytes() for v in held.values()])

    return multiplied


def _assemble(batches):
    """From rows sorted by chunk and kind: the documents of a chunk with all sums added."""
    docs, total = None, None

    def close():
        ids, missing, n_bytes, n_tokens = docs.T
        n_tokens = n_tokens + total[: len(docs)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, mask=missing.astype(bool)), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > LIMIT)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    for batch in batches:
        for kind, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if kind == 0:
                if docs is not None:
                    yield from close()
                docs, total = np.frombuffer(payload, dtype="<i8").reshape(-1, 4), np.zeros(CHUNK, dtype=np.int64)
            else:
                total += np.frombuffer(payload, dtype="<u4")
    if docs is not None:
        yield from close()


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > LIMIT).

    The tokenizer is a byte-level BPE file. Its special strings inside a text count as one token each. `docs` needs
    doc_id and text; other columns are ignored. Null and empty texts have 0 bytes and 0 tokens. Repeated rows give a
    row each, an empty table none. A document with 2**32 tokens or more is too long.
    """
    ship_code(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.mapInArrow(_frequencies(tokenizer_path), ROWS)
    met = rows.repartition("token").sortWithinPartitions("token").mapInArrow(_multiply(tokenizer_path), SUMS)
    return met.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_assemble, COUNTED)
