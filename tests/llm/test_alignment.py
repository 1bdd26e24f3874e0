"""Token alignment against whole texts encoded at once, with plain counting."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from subscope.llm import token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    (300, "漢字かな 🙂🙂🏽 é é ſt ǅ 𐍈𐍈 ﷽"),
    (301, "<|endoftext|>x <s> </s> <unk> <0x41> <|endoftext|> x"),
    (302, "a ▁ b▁c"),
    (303, "  two  spaces   and\n\n lines \r\n\t tabs  "),
    (304, "x" * 3000 + " " + "ab" * 2000),
    (305, "\x00 nul \x1c\x1d \x85     　 end "),
    (306, " leading"),
    (307, "trailing "),
    (308, " "),
    (309, "don't we'll   'tis '' 'S it's"),
    (310, "🙂" * 200),
    (311, "漢 字 🙂 é x‍y"),
]


def decoder():
    """The bytes of byte-level letters, made the other way round than the operator does."""
    found, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            found[chr(b)] = b
        else:
            found[chr(256 + n)] = b
            n += 1
    return found


def brute(rows):
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = decoder()
    docs = []
    for doc_id, text in rows:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            ids_a = ids_b = []
        ends = []
        for parts in (bytes_a, bytes_b):
            at, own = 0, []
            for part in parts:
                at += len(part)
                own.append(at)
            ends.append(own)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts] if ids_a else []
        for side, (ids, own) in enumerate(((ids_a, ends[0]), (ids_b, ends[1]))):
            for i, end in zip(ids, own):
                groups[bisect_left(cuts, end)][side].append(i)
        docs.append((doc_id, ids_a, ids_b, groups))
    holders = Counter(pair for *_, groups in docs for pair in {(x, y) for g in groups for x in g[0] for y in g[1]})
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, ids_a, ids_b, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        best = sum(holders[p] == highest[p[0]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(links), best, sum(holders[p] for p in links), digest))
    return sorted(out, key=lambda r: (r[0] is None, r))


def found(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("chunk_docs", [3, 8192])
def test_tricky_and_odd_texts(make_docs, tricky, monkeypatch, chunk_docs):
    monkeypatch.setattr(token_alignment, "CHUNK_DOCS", chunk_docs)
    rows = tricky + ODD + [(None, "no id"), (None, None)]
    assert found(token_alignment.aligned(make_docs(rows), A, B)) == brute(rows)


def test_texts_of_odd_characters(make_docs, monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHE", 50)
    rng = random.Random(8)
    letters = "aab éé漢🙂\n\t  .,'-▁\x00ß0Ω "
    rows = [(i, "".join(rng.choices(letters[:-1] if i % 5 else letters, k=rng.randint(1, 80)))) for i in range(600)]
    assert found(token_alignment.aligned(make_docs(rows), A, B)) == brute(rows)


def test_groups_as_text(make_docs):
    row = token_alignment.aligned(make_docs([(1, "hello world")]), A, B, with_groups=True).collect()[0]
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"] and row["groups"].count("|") == row["n_groups"]


def test_coarse_cuts_are_spans_and_fine_ones_bytes():
    def ends(spans, sizes):
        return token_alignment._ends(*np.array(spans).T, np.array(sizes)).tolist()

    # A token for a letter, then three that share the character at 1..4, the last of which also holds the next letter.
    assert ends([(0, 1), (1, 4), (1, 4), (1, 5)], [1, 1, 1, 2]) == [1, 2, 3, 5]
    # Byte-fallback pieces have empty spans but for the last.
    assert ends([(0, 1), (1, 1), (1, 1), (1, 4), (4, 6)], [1, 1, 1, 1, 2]) == [1, 2, 3, 4, 6]


def test_large_groups_are_counted_by_distinct_ids(make_docs, monkeypatch):
    monkeypatch.setattr(token_alignment, "LARGE_GROUP", 1)
    rows = [(i, t) for i, t in ODD] + [(1, "notwithstanding 漢漢漢 漢 internationalization")]
    assert found(token_alignment.aligned(make_docs(rows), A, B)) == brute(rows)


def test_empty_table(make_docs):
    assert token_alignment.aligned(make_docs([], 1), A, B).count() == 0


def test_words_are_not_held_beside_the_sums():
    tools = token_alignment.load(A, B)
    before = list(token_alignment.aligned_texts(["some words, and others"], tools))
    assert token_alignment._young
    assert list(token_alignment._sum_up(iter([]))) == []
    assert not token_alignment._young and not token_alignment._old
    again = list(token_alignment.aligned_texts(["some words, and others"], tools))
    assert [x[:5] for x in again] == [x[:5] for x in before]
