"""Packing of documents into token sequences: best-fit decreasing per partition, certified by lower bounds.

Every partition packs its pieces by best-fit decreasing. Dual feasible functions give a lower bound of the sequences
that its pieces need; a partition that reaches its bound is final. In the others full sequences are final, and
the pieces of the rest are exchanged: dealt anew into as many partitions as their number asks for, they are packed again,
until all of them fit into one partition, reach their bound, or exchanges save next to nothing. Then only the sequences
filled to at most half, of which best fit leaves one in a partition, are brought together.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held

CAPACITY = 4096
END = 1
#: Most distinct chunks of text whose ids a Python worker remembers, and the longest of them.
REMEMBERED = 1_000_000
REMEMBERED_LENGTH = 40
#: Characters of the texts that are looked up at a time, about.
CHARACTERS = 1 << 18
#: Parts of text that are tokenized at once, and what stands between them: a mark with an id of its own.
PARTS, APART = 128, "\x7f"
#: Pieces that one task packs at a time, about, at every level of the exchange.
PIECES = 100_000
#: An exchange that saves no more than one sequence in so many partitions is the last one.
PARTITIONS_PER_SAVED = 10

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECE + ", sequence long, offset long, final boolean, filled long"


@lru_cache(maxsize=2)
def _tokenizer(path: str, plain: bool = False):
    """The tokenizer of a file; with `plain` only for words of _PLAIN letters, which it leaves as they are.

    The file's own rules, normal form, lower case and a pattern that parts letters from the rest, change nothing there.
    """
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if plain:
        tokenizer.normalizer = normalizers.Sequence([])
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytewise])
    return tokenizer


_known: dict[str, dict[str, bytes]] = {}
# The mark comes first, so that the search runs from mark to mark and looks back only there.
_MARK = re.compile(r"[.,](?<=[a-z\xdf-\xf6\xf8-\xff].)(?= |$)")
_PLAIN = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")


def _chunks(text: str) -> list[str]:
    """Parts of a text that the tokenizer never joins: it drops white space, and takes runs of letters and of marks apart.

    In Latin-1 texts letters are lowered as it does and a single full stop or comma after a letter is a part of its
    own, which makes the parts fewer. Texts that may hold its special strings are only parted at white space.
    """
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = _MARK.sub(r" \g<0>", text.lower())
        except UnicodeEncodeError:
            pass
    return text.split(" ")


def _encoded(tokenizer, parts: list[str]) -> Iterator[bytes]:
    """The ids of each part. PARTS of them go through the tokenizer as one text and are told apart by the mark's id.

    Where the mark itself, or a special string, may be in the parts, they are tokenized one by one.
    """
    mark = tokenizer.encode(APART, add_special_tokens=False).ids
    groups = [parts[i : i + PARTS] for i in range(0, len(parts), PARTS)]
    texts = [f" {APART} ".join(group) for group in groups]
    for group, text, found in zip(groups, texts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        ids = np.array(found.ids, dtype="<u4")
        ends = 4 * np.flatnonzero(ids == mark[0])
        if len(mark) == 1 and len(ends) == len(group) - 1 and "<|" not in text:
            data, starts = ids.tobytes(), [0, *(ends + 4).tolist()]
            yield from map(data.__getitem__, map(slice, starts, [*ends.tolist(), len(data)]))
        else:
            for one in tokenizer.encode_batch_fast(group, add_special_tokens=False):
                yield array("I", one.ids).tobytes()


def _runs(texts: pa.Array) -> Iterator[list[str]]:
    """Texts one after another, null as empty, in runs of about CHARACTERS characters and one text at least."""
    run, size = [], 0
    for text in texts:
        text = text.as_py() or ""
        run.append(text)
        size += len(text)
        if size >= CHARACTERS:
            yield run
            run, size = [], 0
    yield run


def _ids(path: str, known: dict[str, bytes], texts: list[str]) -> Iterator[bytes]:
    """The ids of each text. Parts that are not in `known` yet are tokenized together and, unless long, remembered."""
    parts = [_chunks(text) for text in texts]
    found = [list(map(known.get, own)) for own in parts]
    missing = dict.fromkeys(chunk for own, ids in zip(parts, found) for chunk, x in zip(own, ids) if x is None)
    sides = [chunk for chunk in missing if _PLAIN.fullmatch(chunk)], [chunk for chunk in missing if not _PLAIN.fullmatch(chunk)]
    new = {}
    for plain, side in zip((True, False), sides):
        new.update(zip(side, _encoded(_tokenizer(path, plain), side)))
    if len(known) + len(new) > REMEMBERED:
        known.clear()
    known.update((chunk, ids) for chunk, ids in new.items() if len(chunk) <= REMEMBERED_LENGTH)
    for own, ids in zip(parts, found):
        yield b"".join([new[chunk] if x is None else x for chunk, x in zip(own, ids)])


def _pieces(path: str, end: int):
    """Every distinct part of the texts is tokenized once and remembered."""

    def cut(batches):
        known = _known.setdefault(path, {})
        last = np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            encoded = (ids for run in _runs(batch.column(1)) for ids in _ids(path, known, run))
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * CAPACITY)):
                    part = ids[at : at + 4 * CAPACITY]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return cut


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that pieces of these lengths need at least: the best of the dual feasible functions u_k and f_t.

    f_t counts lengths over capacity - t as whole sequences and drops those under t; u_k rounds (k + 1) * length /
    capacity down to a multiple of 1 / k unless it is whole. Both never make more fit than really does.
    """
    if not len(lengths):
        return 0
    values, counts = np.unique(lengths, return_counts=True)
    best = -(-int((values * counts).sum()) // capacity)
    below = np.concatenate([[0], np.cumsum(values * counts)])
    number = np.concatenate([[0], np.cumsum(counts)])
    for t in np.unique(np.minimum(values[values <= capacity // 2], capacity // 2)).tolist():
        big = int(np.searchsorted(values, capacity - t, "right"))
        small = int(np.searchsorted(values, t, "left"))
        whole = number[-1] - number[big]
        middle = below[big] - below[small]
        best = max(best, int(whole) - (-int(middle) // capacity))
    for k in range(1, 21):
        exact = (values * (k + 1)) % capacity == 0
        weight = np.where(exact, values * k, (values * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((weight * counts).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece by best-fit decreasing, and the number of sequences.

    Open sequences wait in a list per free space; a bit set of the spaces in use finds the tightest that fits.
    """
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, opened = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = used >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            target = open_at[room].pop()
            if not open_at[room]:
                used &= ~(1 << room)
        else:
            room, target = capacity, opened
            opened += 1
        sequence[i], offset[i] = target, capacity - room
        rest = room - need
        if rest:
            open_at[rest].append(target)
            used |= 1 << rest
    return sequence, offset, opened


def _pack(level: int):
    def packed(batches):
        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        part = TaskContext.get().partitionId()
        lengths = table.column("length").to_numpy()
        sequence, offset, opened = best_fit(lengths)
        filled = np.bincount(sequence, weights=lengths, minlength=opened)
        certified = opened == lower_bound(lengths)
        final = (filled[sequence] == CAPACITY) | certified
        number = (np.int64(level) << 56) + (np.int64(part) << 32) + sequence
        inside = filled[sequence].astype(np.int64)
        for name, values in (("sequence", number), ("offset", offset), ("final", final), ("filled", inside)):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches()

    return packed


def pieces_of(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of every text and the end id, cut after every 4096."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_pieces(tokenizer_path, END), PIECE)


def packed(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    `docs` needs doc_id and text; other columns are ignored. Null and empty texts are one piece with the end id alone.
    Repeated rows are packed each for itself. An empty table gives no rows. Every task of every level packs about PIECES
    pieces; a certified partition is final, the others pass on the pieces of their sequences with free space.
    """
    held = Held(docs.sparkSession)
    columns = [c.split()[0] for c in PIECE.split(", ")]
    todo = held.table(pieces_of(docs, tokenizer_path))
    count = todo.count()
    results, level, halved, earlier, before = [], 0, False, None, 0
    while count:
        parts = -(-count // PIECES)
        # Dealt by hash, so each partition gets the same mix of lengths and copies are spread.
        dealt = todo.repartition(parts, F.xxhash64("doc_id", "piece", F.lit(level)))
        done = held.table(dealt.mapInArrow(_pack(level), PACKED))
        saved = before - done.where("offset = 0").count()
        if earlier is not None and saved <= parts // PARTITIONS_PER_SAVED:
            better = done if saved > 0 else earlier
            if halved:
                results.append(better)
                break
            halved = True
            results.append(better.where(2 * F.col("filled") > CAPACITY))
            rest = better.where(2 * F.col("filled") <= CAPACITY)
        elif parts == 1:
            results.append(done)
            break
        else:
            results.append(done.where("final"))
            rest = done.where("NOT final")
        count, before = rest.agg(F.count("*"), F.count_if(F.col("offset") == 0)).head()
        todo, earlier, level = rest.select(*columns), rest, level + 1
    every = results[0] if results else todo.select("*", F.lit(0).cast("long").alias("sequence"), F.lit(0).cast("long").alias("offset"))
    for more in results[1:]:
        every = every.union(more)
    return every.select(*columns, F.col("sequence").alias("sequence_id"), "offset")
