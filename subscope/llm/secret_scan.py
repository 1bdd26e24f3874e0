"""Secrets in texts: three fixed patterns, and a battery of randomness tests over other long tokens.

A token's encoding is inferred from its characters. Under the hypothesis that its symbols are drawn evenly, a chi-squared
test of the alphabet, a runs test about the median symbol and a lag-one serial correlation test each give a p-value;
Fisher's method combines them to one score, near 0 for text and anywhere up to 1 for random strings. What the battery does
not reject is held against a fixed null model of text: a Markov chain over lower case, upper case, digits and marks, with
vowels and consonants in turn and letters by their usual frequency in European languages. The likelihood of a token
under the null over that under even draws is a p-value by Markov's inequality, whatever the corpus holds. In each length
class the procedure of Benjamini and Hochberg bounds the false discoveries among the distinct tokens of all documents,
counted as histograms of bounded size. Digits alone look the same in text and in keys, and are never found.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held

#: Accepted share of false discoveries among the tokens that the battery adds, in every length class.
FALSE_DISCOVERIES = 0.05
#: Lower bounds of the length classes; shorter tokens say too little.
LENGTHS = [20, 24, 32, 40, 64, 128, 256]
#: P-values are counted by their binary logarithm, in so many steps.
STEPS = 1000
#: Tokens with a lower score are not drawn evenly.
LEAST_SCORE = 1e-5
KINDS = ["assign", "access", "hex", "random"]

_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
# The minimum lengths are part of these two patterns: a run that is too short holds no longer one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % LENGTHS[0])
_WORD = re.compile(r"[A-Za-z]?[a-z]+|[A-Z]+")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
_ENCODINGS = [
    ("decimal", _DIGITS),
    ("hex", _DIGITS + "abcdef"),
    ("upper hex", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower", _UPPER.lower()),
    ("base36", _DIGITS + _UPPER.lower()),
    ("upper base36", _DIGITS + _UPPER),
    ("base62", _DIGITS + _UPPER + _UPPER.lower()),
    ("base64", _DIGITS + _UPPER + _UPPER.lower() + "+/_-"),
]
_TABLES = [(re.compile(f"[{re.escape(a)}]+"), {c: i for i, c in enumerate(a)}, min(len(a), 64)) for _, a in _ENCODINGS]

#: The null model of text: chances of the next kind of symbol, and of each symbol within its kind.
_NEXT = {
    "": {"l": 0.45, "u": 0.25, "d": 0.15, "-": 0.15},
    "l": {"l": 0.90, "u": 0.02, "d": 0.02, "-": 0.06},
    "u": {"l": 0.45, "u": 0.45, "d": 0.05, "-": 0.05},
    "d": {"l": 0.03, "u": 0.02, "d": 0.85, "-": 0.10},
    "-": {"l": 0.60, "u": 0.15, "d": 0.20, "-": 0.05},
}
#: The chance of a vowel after another sign, a vowel and a consonant.
_VOWEL = {"": 0.35, "v": 0.15, "c": 0.60}
_VOWELS = {"e": 32, "a": 22, "i": 20, "o": 16, "u": 10}
_CONSONANTS = dict(zip("nrtsldhcmpgfbvwykzjxq", [10, 9, 9, 9, 6, 5, 4, 4, 4, 3, 2.5, 2, 2, 1.5, 1.5, 1.5, 1.5, 0.7, 0.5, 0.3, 0.3]))
_SIGNS = {c: "d" for c in _DIGITS} | {c: "l" for c in _UPPER.lower()} | {c: "u" for c in _UPPER} | {c: "-" for c in "+/_-"}


def _symbol(before: str, c: str) -> float:
    """Binary logarithm of the chance of `c` after `before` (empty at the start) under the null model of text."""
    kind = _SIGNS[c]
    chance = _NEXT[_SIGNS.get(before, "")][kind]
    if kind in "d-":
        return math.log2(chance / (10 if kind == "d" else 4))
    last = before.lower()
    vowel = _VOWEL["v" if last in _VOWELS else "c" if last in _CONSONANTS else ""]
    own, part = (_VOWELS, vowel) if c.lower() in _VOWELS else (_CONSONANTS, 1 - vowel)
    return math.log2(chance * part * own[c.lower()] / sum(own.values()))


_CHANCES = {before + c: _symbol(before, c) for before in ["", *_SIGNS] for c in _SIGNS}


SCANNED = "doc_id long, base array<struct<start:int,kind:int,end:int>>, tokens array<struct<start:int,end:int,class:int,step:int,word:boolean,hash:long>>"


def _upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def score(token: str) -> float:
    """Fisher's combined p-value of the three tests under the inferred encoding, the one with the smallest alphabet."""
    for pattern, table, size in _TABLES:
        if pattern.fullmatch(token):
            break
    x = np.array([table[c] for c in token], dtype=float)
    n = len(x)
    counts = np.bincount(x.astype(int), minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    freedom = size - 1
    # Wilson and Hilferty: the cube root of chi-squared over its degrees of freedom is nearly normal.
    wilson = ((chi / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)) if chi > 0 else -9.0
    even = _upper_normal(wilson)
    above = x > (size - 1) / 2
    high = int(above.sum())
    low = n - high
    if high and low:
        expected = 1 + 2 * high * low / n
        spread = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
        runs = 2 * _upper_normal(abs(1 + int((above[1:] != above[:-1]).sum()) - expected) / math.sqrt(max(spread, 1e-9)))
    else:
        runs = 2.0 ** (1 - n)
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = 2 * _upper_normal(abs(float((centred[1:] * centred[:-1]).sum()) / power) * math.sqrt(n)) if power else 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (even, runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def steps(token: str) -> int:
    """-log2 of the p-value of `token` under the null model of text, rounded down to 0 ... STEPS; 0 where the battery rejects.

    The likelihood ratio of even draws from the inferred alphabet, each alphabet as likely, is at least t with a
    chance of 1 / t at most if the token is text.
    """
    text = _CHANCES[token[0]] + sum(_CHANCES[token[i : i + 2]] for i in range(len(token) - 1))
    alphabet = next(a for (pattern, _, _), (_, a) in zip(_TABLES, _ENCODINGS) if pattern.fullmatch(token))
    drawn = -len(token) * math.log2(len(alphabet)) - math.log2(len(_ENCODINGS))
    found = max(0, min(STEPS, math.floor(drawn - text)))
    return found if found and score(token) >= LEAST_SCORE else 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def tokens(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, bool, int]]:
    """(start, end, length class, p-value in steps, whether it is a plain word, hash) of the long tokens outside `base`."""
    found = []
    for m in _TOKEN.finditer(text):
        if any(start < m.end() and end > m.start() for start, _, end in base):
            continue
        token = m[0]
        length_class = sum(len(token) >= bound for bound in LENGTHS) - 1
        digest = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little", signed=True)
        found.append((m.start(), m.end(), length_class, steps(token), bool(_WORD.fullmatch(token)), digest))
    return found


def _scan(batches):
    kinds = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    rows = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("class", pa.int32()), ("step", pa.int32()),
                      ("word", pa.bool_()), ("hash", pa.int64())])
    for batch in batches:
        bases, others = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            bases.append([dict(zip(("start", "kind", "end"), s)) for s in base])
            others.append([dict(zip(("start", "end", "class", "step", "word", "hash"), t)) for t in tokens(text, base)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(bases, pa.list_(kinds)), pa.array(others, pa.list_(rows))],
            names=["doc_id", "base", "tokens"],
        )


def thresholds(scanned: DataFrame) -> dict[int, int]:
    """Per length class the lowest step that counts as random; a class without any is absent. Plain words are not tested."""
    each = scanned.select(F.explode("tokens").alias("t")).select("t.*").where("NOT word").dropDuplicates(["hash", "class"])
    seen = np.zeros((len(LENGTHS), STEPS + 1))
    for row in each.groupBy("class", "step").count().collect():  # at most classes x steps rows
        seen[row["class"], row["step"]] = row["count"]
    found = {}
    for c, own in enumerate(seen):
        above = own[::-1].cumsum()[::-1]
        passed = np.flatnonzero((above > 0) & (0.5 ** np.arange(STEPS + 1) * own.sum() <= FALSE_DISCOVERIES * above))
        if len(passed):
            found[c] = int(passed[0])
    return found


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(text, ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end in code points, end exclusive).

    `docs` needs doc_id and text; other columns are ignored. Null texts count as empty: no spans, and the digest of the
    empty string. A token that overlaps a fixed pattern is never added. Repeated rows give a row each.
    """
    held = Held(docs.sparkSession)
    scanned = held.table(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan, SCANNED))
    least = thresholds(scanned)
    test = " OR ".join(f"(t.class = {c} AND t.step >= {step})" for c, step in least.items()) or "false"
    added = f"transform(filter(tokens, t -> NOT t.word AND ({test})), t -> named_struct('start', t.start, 'kind', 3, 'end', t.end))"
    every = F.sort_array(F.concat("base", F.expr(added)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"),
    )


def _redact(least):
    def redact(batches):
        for batch in batches:
            texts = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                random = [(s, 3, e) for s, e, c, step, word, _ in tokens(text or "", base) if not word and step >= least.get(c, STEPS + 1)]
                parts, at = [], 0
                for start, kind, end in sorted(base + random):
                    if end <= at:
                        continue
                    parts += [text[at:start], f"[{KINDS[kind]}]"] if start >= at else []
                    at = end
                texts.append("".join([*parts, text[at:]]) if parts else text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field("text").type))

    return redact


def redacted(docs: DataFrame) -> DataFrame:
    """The same rows with every secret in `text` replaced by the name of its kind in brackets.

    Where there is a column n_chars, it becomes the length of the new text; null texts and other columns stay.
    """
    held = Held(docs.sparkSession)
    scanned = held.table(docs.select(F.lit(0).cast("long").alias("doc_id"), "text").mapInArrow(_scan, SCANNED))
    least = thresholds(scanned)
    held.drop(scanned)
    redacted = docs.mapInArrow(_redact(least), docs.schema)
    if "n_chars" not in docs.columns:
        return redacted
    length = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return redacted.withColumn("n_chars", length)
