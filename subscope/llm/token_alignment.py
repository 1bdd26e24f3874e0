"""Alignment of two tokenizers: groups of tokens over the same bytes, and which ids go together in the whole corpus.

Tokenizer A is a byte-level BPE file, B a sentencepiece model. A gives each token's span in characters, B's proto each
piece's span in bytes. These spans are the coarse cuts. Where several tokens share a character (bytes of a multibyte
character in A, byte-fallback pieces in B, which all but the last have empty spans), the decoded bytes of the tokens
place their ends inside it. The ends that both have cut the tokens into groups.

Texts fall into words at places that neither tokenizer joins: before a single space, between a letter and a mark, and
behind a line end. A's pre-tokens end there by their pattern; no piece of B holds two such neighbours, which is tested when
the model is loaded (else whole texts are encoded). A word begins with a space or stands for itself, and a worker keeps
the alignments of CACHE words twice over.

Counts travel by chunk of documents, not by document. A task numbers the id pairs of a chunk and writes one row for each
document, with the places of its pairs in that list, and one for the list. The pairs of all lists are counted, joined
with their counts, and sent back to their chunk, where the documents are summed. A pair that is in every document is one
row for each chunk, and Spark may split the join on it.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held

#: A chunk of documents ends after so many characters, or so many documents.
CHUNK_CHARS = 4 << 20
CHUNK_DOCS = 8192
#: Texts are split and encoded in runs of about so many characters, or so many documents.
RUN_CHARS = 1 << 21
RUN_DOCS = 4096
#: Words that a worker remembers in each of its two generations, and words that are encoded as one text.
CACHE = 250_000
WORDS_OF_TEXT = 400
#: Longer words are not remembered.
LONGEST = 200
#: Groups with more links are counted by distinct ids.
LARGE_GROUP = 64
#: Bits of an id; a pair is a * 2**SHIFT + b.
SHIFT = 24

ROWS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
    " places binary, times binary, pairs array<long>, holders array<long>"
)
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
)

# White space of Python holds that of both tokenizers, so \S is none for either.
_SPACE = re.compile(r"(?<=\S) (?=\S)")
_NEAR_SPACE = re.compile(r"^ | $|\s | \s")
# Behind a line end only where a mark comes before it: then it stands alone.
_PART = re.compile(r"(?<=[^\W\d_])(?=[.,;:!?\n])|(?<=[.,;:!?]\n)(?=[^\W\d_])")
_MARKS = ".,;:!?\n"
#: Between words that begin without a space.
_GUARD = "\n"

_NOTHING = ("", 0, 0, 0, 0, (), None)


class Tokenizers(NamedTuple):
    a: object
    b: object
    bytes_a: list
    bytes_b: list
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    #: Whether words can be encoded alone.
    by_words: bool


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable bytes as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Tokenizers:
    """Both tokenizers, and the bytes of every id."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
    gc.set_threshold(200_000)  # remembered words are many objects without cycles
    a = Tokenizer.from_file(path_a)
    a.no_truncation()
    a.no_padding()
    a.encode_special_tokens = True
    letters = _byte_letters()
    bytes_a = [b""] * a.get_vocab_size()
    for entry, i in a.get_vocab(with_added_tokens=False).items():
        bytes_a[i] = bytes(letters[c] for c in entry)
    b = SentencePieceProcessor(model_file=path_b)
    bytes_b, by_words = [], True
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        if not b.is_byte(i):
            by_words &= not any(
                y == "▁" != x or (x.isalpha() and y in _MARKS) or x == "\n" for x, y in zip(piece, piece[1:])
            )
    assert max(len(bytes_a), len(bytes_b)) <= 1 << SHIFT
    sizes = [np.array(list(map(len, x)), dtype=np.int64) for x in (bytes_a, bytes_b)]
    return Tokenizers(a, b, bytes_a, bytes_b, *sizes, by_words)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers one after the other, and where each begins (with the end of the last)."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(ends[-1])), ends


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1 ... for sizes[i] numbers each."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _ends(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes, from the spans and decoded sizes of all tokens.

    A span that ends before the next one begins is taken as it is. A token that shares its last character with the
    next one, or has an empty span, ends its decoded bytes behind the nearest such end before it.
    """
    coarse = begins < ends
    coarse[:-1] &= begins[1:] >= ends[:-1]
    behind = np.concatenate([[0], np.cumsum(sizes)])
    anchor = np.maximum.accumulate(np.where(coarse, np.arange(1, len(ends) + 1), 0))
    return np.concatenate([[0], ends])[anchor] + behind[1:] - behind[anchor]


def _counted(ids: list) -> dict:
    found: dict = {}
    for x in ids:
        found[x] = found.get(x, 0) + 1
    return found


def _links(a: list, b: list) -> dict:
    """The id pairs of one group with their times."""
    count_b = _counted(b)
    return {(x << SHIFT) + y: n * m for x, n in _counted(a).items() for y, m in count_b.items()}


def aligned_words(words: list[str], tools: Tokenizers) -> list[tuple | None]:
    """Per word: groups as text, n_a, n_b, n_groups, n_links, the id pairs of its links, and their times (None: one each).

    None for a word whose tokens do not give its bytes. Many words are encoded as one text: those with a space before
    them follow each other, those without are kept apart by line ends, and odd ones are encoded alone.
    """
    spaced, bare, odd = [], [], []
    for i, w in enumerate(words):
        if w[-1].isspace() or w[1:2].isspace():
            odd.append(i)
        elif w[0] == " ":
            spaced.append(i)
        else:
            (bare if w[0].isalpha() else odd).append(i)
    out: list = [None] * len(words)
    for at in range(0, len(spaced), WORDS_OF_TEXT):
        _align_into(out, spaced[at : at + WORDS_OF_TEXT], words, tools)
    for at in range(0, len(bare), WORDS_OF_TEXT):
        _align_into(out, bare[at : at + WORDS_OF_TEXT], words, tools)
    for i in odd:
        _align_into(out, [i], words, tools)
    return out


def _align_into(out: list, places: list[int], words: list[str], tools: Tokenizers) -> None:
    """Aligns the words at `places` as one text, or by halves if that does not give its bytes."""
    some = [words[i] for i in places]
    if some[0][0] == " ":
        found = _aligned_sequence(some, tools)
    else:
        # A word that begins with a mark is encoded alone, behind a letter as in its text.
        guard = _GUARD if some[0][0].isalpha() else "x"
        found = _aligned_sequence([x for w in some for x in (guard, w)], tools, " ")
        found = found and found[1::2]
    if found:
        for i, known in zip(places, found):
            out[i] = known
    elif len(places) > 1:
        half = len(places) // 2
        _align_into(out, places[:half], words, tools)
        _align_into(out, places[half:], words, tools)


def _aligned_sequence(words: list[str], tools: Tokenizers, before: str = "") -> list[tuple] | None:
    """The alignments of words that follow each other in a text; None if its tokens do not give its bytes.

    The text begins with a space, its own or `before`, which B adds to what follows.
    """
    text = before + "".join(words)
    encoded, raw = tools.a.encode(text, add_special_tokens=False), text.encode()
    ids_a, pieces = encoded.ids, tools.b.encode(text[1:], return_type="proto").pieces
    found_b = [number for piece in pieces for number in (piece.id, piece.begin, piece.end)]
    ids_b = found_b[::3]
    if not b"".join(map(tools.bytes_a.__getitem__, ids_a)) == raw == b"".join(map(tools.bytes_b.__getitem__, ids_b)):
        return None
    flat_a, found_b = np.array(ids_a), np.array(found_b).reshape(-1, 3)
    flat_b, spans_b = found_b[:, 0], found_b[:, 1:] + 1
    spans_a = np.fromiter(chain.from_iterable(encoded.offsets), dtype=np.int64, count=2 * len(ids_a)).reshape(-1, 2)
    base = np.cumsum([len(before), *map(len, words)])
    if len(raw) != len(text):  # the spans of A and the words are in characters
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        at = np.concatenate([[0], np.cumsum(1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))])
        spans_a, base = at[spans_a], at[base]
    ends_a = _ends(spans_a[:, 0], spans_a[:, 1], tools.sizes_a[flat_a])
    ends_b = _ends(spans_b[:, 0], spans_b[:, 1], tools.sizes_b[flat_b])

    cuts = ends_a[ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a]
    groups = np.searchsorted(cuts, base, "right")
    if not (cuts[groups[1:] - 1] == base[1:]).all():
        return None  # a word does not stand for itself here
    edges_a, edges_b = np.searchsorted(ends_a, base, "right"), np.searchsorted(ends_b, base, "right")
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    large = in_a * in_b > LARGE_GROUP
    times = np.where(large[group_a], 0, in_b[group_a])
    pairs = ((np.repeat(flat_a, times) << SHIFT) + flat_b[_spread(first_b[group_a], times)]).tolist()
    links = np.concatenate([[0], np.cumsum(times)])[edges_a].tolist()
    n_links = np.concatenate([[0], np.cumsum(in_a * in_b)])[groups]

    text_a, text_b = list(map(str, ids_a)), list(map(str, ids_b))
    texts = [
        f"{text_a[i]}|{text_b[j]}" if n == m == 1 else f"{','.join(text_a[i : i + n])}|{','.join(text_b[j : j + m])}"
        for i, n, j, m in zip(first_a.tolist(), in_a.tolist(), first_b.tolist(), in_b.tolist())
    ]
    numbers = np.stack([np.diff(edges_a), np.diff(edges_b), np.diff(groups), np.diff(n_links)], axis=1).tolist()
    groups = groups.tolist()
    out = [
        (";".join(texts[groups[k] : groups[k + 1]]), *own, tuple(pairs[links[k] : links[k + 1]]), None)
        for k, own in enumerate(numbers)
    ]
    for g in np.flatnonzero(large).tolist():
        k = int(np.searchsorted(base, cuts[g])) - 1
        if k < 0:
            continue  # the space before the first word
        *head, own, own_times = out[k]
        more = _links(flat_a[group_a == g].tolist(), flat_b[group_b == g].tolist())
        out[k] = (*head, own + tuple(more), (own_times or (1,) * len(own)) + tuple(more.values()))
    return out


_young: dict = {}
_old: dict = {}


def _forget() -> None:
    """Frees the remembered words: a worker that goes on with other work would hold them beside it."""
    global _young, _old
    _young, _old = {}, {}
    pa.default_memory_pool().release_unused()


def _remembered(words: Iterable[str], found: list) -> list[int]:
    """Fills `found` from the two generations that the worker keeps; the places of the words that are in neither."""
    new = []
    for i, w in enumerate(words):
        known = _young.get(w, _old)
        if known is _old:  # not among the young
            known = _old.get(w, _young)
            if known is _young:
                new.append(i)
            else:
                _young[w] = known
        found.append(known)
    return new


def _known(words: list[str], tools: Tokenizers) -> list[tuple | None]:
    """The alignments of distinct words, remembered or composed of parts that are remembered or aligned now."""
    global _young, _old
    found: list = []
    new = _remembered(words, found)
    parts = [[words[i]] if words[i][1:].isalpha() or not tools.by_words else _PART.split(words[i]) for i in new]
    distinct = list(dict.fromkeys(chain.from_iterable(parts)))
    of_parts: list = []
    unseen = _remembered(distinct, of_parts)
    for i, known in zip(unseen, aligned_words([distinct[i] for i in unseen], tools)):
        of_parts[i] = known
        if len(distinct[i]) < LONGEST:
            _young[distinct[i]] = known
    by_part = dict(zip(distinct, of_parts))
    for i, own in zip(new, parts):
        if len(own) == 1:
            found[i] = by_part[own[0]]
        else:
            found[i] = _composed([by_part[p] for p in own])  # not remembered: most words with marks are rare
    if len(_young) > CACHE:
        _young, _old = {}, _young
    return found


def aligned_texts(texts: list[str | None], tools: Tokenizers) -> Iterator[tuple]:
    """Per text: groups, n_a, n_b, n_groups, n_links, and its distinct id pairs with the times that each is linked."""
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars < RUN_CHARS):
            chars += len(texts[to] or "")
            to += 1
        yield from _aligned_run([_split(t, tools.by_words) if t else [] for t in texts[at:to]], tools)
        at = to


def _split(text: str, by_words: bool) -> list[str]:
    """The words of a text without the space before each."""
    if not by_words:
        return [text]
    return _SPACE.split(text) if _NEAR_SPACE.search(text) else text.split(" ")


def _composed(parts: list[tuple | None]) -> tuple | None:
    """The alignment of neighbours as one."""
    if None in parts:
        return None
    groups, n_a, n_b, n_groups, n_links, pairs, times = zip(*parts)
    if any(t is not None for t in times):
        times = tuple(chain.from_iterable(t or (1,) * len(p) for t, p in zip(times, pairs)))
    else:
        times = None
    return ";".join(groups), sum(n_a), sum(n_b), sum(n_groups), sum(n_links), tuple(chain.from_iterable(pairs)), times


def _aligned_run(split: list[list[str]], tools: Tokenizers) -> Iterator[tuple]:
    place = dict.fromkeys(chain.from_iterable(split))
    known = _known([" " + w for w in place], tools)
    place = dict(zip(place, range(len(place))))
    edges = np.cumsum([0, *map(len, split)])
    ids = np.fromiter(map(place.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(edges[-1]))
    lost = np.zeros(len(known), dtype=bool)
    for i in [i for i, k in enumerate(known) if k is None]:
        lost[i], known[i] = True, _NOTHING
    whole = np.diff(np.concatenate([[0], np.cumsum(lost[ids])])[edges]) == 0
    numbers = np.fromiter(chain.from_iterable(map(itemgetter(1, 2, 3, 4), known)), np.int64, 4 * len(known)).reshape(-1, 4)
    sums = np.vstack([np.zeros(4, dtype=np.int64), np.cumsum(numbers[ids], axis=0)])[edges]
    sums = (np.diff(sums, axis=0) * whole[:, None]).tolist()

    pairs, starts = _flat([k[5] for k in known])
    times = np.ones(len(pairs), dtype=np.int64)
    for i, k in enumerate(known):
        if k[6] is not None:
            times[starts[i] : starts[i + 1]] = k[6]
    sizes = np.diff(starts)[ids]
    where = _spread(starts[ids], sizes)
    doc = np.repeat(np.arange(len(split)), np.diff(edges))
    key = (np.repeat(doc, sizes) << 2 * SHIFT) + pairs[where]
    order = np.argsort(key)
    key = key[order]
    own, of = key & ((1 << 2 * SHIFT) - 1), key >> 2 * SHIFT
    fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (of[1:] != of[:-1])])) if len(own) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(times[where][order], fresh) if len(own) else times
    own, of = own[fresh], of[fresh]
    bounds = np.searchsorted(of, np.arange(len(split) + 1)).tolist()
    texts, ids, edges = [k[0] for k in known], ids.tolist(), edges.tolist()
    for d, ok in enumerate(whole.tolist()):
        some = slice(bounds[d], bounds[d + 1]) if ok else slice(0, 0)
        groups = ";".join([texts[i] for i in ids[edges[d] : edges[d + 1]]]) if ok else ""
        yield groups, *sums[d], own[some], total[some]


def _align(path_a: str, path_b: str, with_groups: bool):
    schema = pa.schema([
        *((name, pa.int64()) for name in ("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()),
        ("groups", pa.string()),
        ("places", pa.binary()),
        ("times", pa.binary()),
        ("pairs", pa.list_(pa.int64())),
        ("holders", pa.list_(pa.int64())),
    ])

    def rows(batches):
        tools = load(path_a, path_b)
        chunk, docs, chars = TaskContext.get().partitionId() << 32, [], 0

        def close():
            pairs, where = np.unique(np.concatenate([d[-2] for d in docs]), return_inverse=True)
            holders = np.bincount(where, minlength=len(pairs))
            out, at = [], 0
            for *head, own, times in docs:
                places = where[at : at + len(own)].astype("<u4").tobytes()
                out.append((chunk, *head, places, times.astype("<u8").tobytes(), None, None))
                at += len(own)
            out.append((chunk, *[None] * 9, pairs, holders))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for start in range(0, len(ids), RUN_DOCS):
                some = texts.slice(start, RUN_DOCS).to_pylist()
                for doc_id, text, (groups, *numbers, pairs, times) in zip(ids[start:], some, aligned_texts(some, tools)):
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    docs.append((doc_id, *numbers, digest, groups if with_groups else None, pairs, times))
                    chars += len(text or "")
                    if len(docs) == CHUNK_DOCS or chars > CHUNK_CHARS:
                        yield from close()
                        chunk, docs, chars = chunk + 1, [], 0
        if docs:
            yield from close()

    return rows


def _sum_up(batches):
    """From the rows of chunks in order, counts by place and then documents: the documents with their sums."""
    _forget()
    chunk, counts, best, parts = None, None, None, []
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        for start, end in _runs(chunks):
            if chunks[start] != chunk:
                chunk, counts, parts = chunks[start], None, []
            some = batch.slice(start, end - start)
            is_doc = some.column(2).to_numpy(zero_copy_only=False)
            n = int(np.searchsorted(is_doc, True))
            if n:
                parts.append((some.column(3).slice(0, n).to_numpy(), some.column(4).slice(0, n).to_numpy()))
            if n == len(some):
                continue
            if counts is None:
                counts = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
                best = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
            docs = some.slice(n)
            n_best, count_sum = [], []
            for places, times in zip(docs.column("places").to_pylist(), docs.column("times").to_pylist()):
                places, times = np.frombuffer(places, dtype="<u4"), np.frombuffer(times, dtype="<u8").astype(np.int64)
                n_best.append(int(times @ best[places]))
                count_sum.append(int(times @ counts[places]))
            kept = {name: docs.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            kept |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
            kept |= {name: docs.column(name) for name in ("groups_sha256", "groups")}
            yield pa.RecordBatch.from_pydict(kept)


def _runs(values: np.ndarray):
    edges = np.flatnonzero(np.diff(values)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(values)]) if len(values) else ()


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents A and B ids are linked, and whether that is the highest of the A id."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("count").alias("highest"))
    joined = counts.withColumn("a", F.shiftright("pair", SHIFT)).join(highest, "a")
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A encodes the text with a space before it, B the text, to which it adds the space; strings of special tokens are
    plain text. A link is a token of A and one of B in the same group, an id pair's count the number of rows that hold
    it linked. n_best counts the links whose pair has the highest count of its A id (ties included), count_sum sums the
    counts over all links. `groups_sha256` is the digest of the groups, `a1,a2|b1;a3|b2,b3` in ids; `with_groups` also
    returns them as text, which is null otherwise.

    `docs` needs doc_id and text; other columns are ignored. Texts that are null or empty, or that a tokenizer does not
    give back byte by byte (such as those with U+2581), have zeros and an empty digest. Repeated rows count and return
    once each, rows without doc_id too; an empty table gives no rows. A word of any length is encoded as a whole.
    """
    held = Held(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = held.table(texts.mapInArrow(_align(path_a, path_b, with_groups), ROWS))
    zipped = F.arrays_zip("pairs", "holders")
    lists = found.where("pairs IS NOT NULL").select("chunk", F.posexplode(zipped).alias("place", "of"))
    lists = lists.select("chunk", "place", F.col("of.pairs").alias("pair"), F.col("of.holders").alias("n"))
    counts = held.table(pair_counts(lists))
    back = lists.join(counts, "pair").select("chunk", "place", F.lit(False).alias("is_doc"), "count", "best")
    own = found.where("pairs IS NULL").drop("pairs", "holders").withColumn("is_doc", F.lit(True))
    met = back.unionByName(own, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "is_doc", "place")
    order = ["chunk", "place", "is_doc", "count", "best", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"]
    return met.select(*order, "places", "times").mapInArrow(_sum_up, ALIGNED)
