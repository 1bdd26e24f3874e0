"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels exist for documents only. Words and word beginnings that occur far more often in toxic documents are the lexicon;
a token of a toxic document that has one is labelled toxic, every other token clean. From these labelled tokens a chain of
two states learns weights for the evidence bins of a token (its word's and its best beginning's) and for the moves
between states. Forward-backward gives each token's probability of being toxic; their sum, maximum and density
make the document's score by a logistic regression on the document labels.

Tokens without an entry in the lexicon are alike, so the chain passes a run of them in one step, by a power of their
common matrix: the result is the same as token by token. Texts are scored whole.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscope.llm.shared import Held

#: At most about so many labelled documents of each class are used for fitting.
TRAIN_PER_CLASS = 4000
#: At most so many lexicon entries, those with the most significant log-odds.
LEXICON = 50_000
#: A beginning has so many characters at most; shorter ones than the first are too common.
BEGINNINGS = range(3, 9)
MIN_DOCUMENTS = 3
MIN_Z = 3.0
#: Lower bounds of the log-odds in a bin; evidence under the first is none.
BINS = [1.5, 2.5, 3.5, 4.5, 5.5]
THRESHOLD = 0.3
#: Tokens whose evidence a task remembers.
REMEMBERED = 300_000
SEGMENT = 128
STEPS = 150

_PUNCTUATION = ".,!?;:*$%&#|'\"()[]{}<>«»„“”…-"
COUNTS = "key string, toxic long, clean long"
FIT = "weights array<double>"
SCORED = "doc_id long, held_out boolean, score double, predicted int, n_toxic_tokens long, spans string"


def keys_of(token: str) -> list[str]:
    """The word (after =) and its beginnings (before ~) of a token in lower case."""
    word = token.strip(_PUNCTUATION)
    return [f"={word}", *(f"{word[:n]}~" for n in BEGINNINGS if len(word) >= n)] if word else []


def _count(batches):
    for batch in batches:
        found: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            for key in {k for token in set((text.as_py() or "").lower().split()) for k in keys_of(token)}:
                found.setdefault(key, [0, 0])[0 if toxic else 1] += 1
        toxic, clean = zip(*found.values()) if found else ([], [])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(toxic, pa.int64()), pa.array(clean, pa.int64())],
            names=["key", "toxic", "clean"],
        )


def _lexicon(train: DataFrame, toxic: int, clean: int) -> dict[str, int]:
    """Bin (from 1) of each key of the lexicon; at most LEXICON entries come to the driver."""
    counted = train.select("text", "toxic").mapInArrow(_count, COUNTS).groupBy("key").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b")
    )
    odds = f"ln((a + 0.5) / ({toxic} - a + 0.5)) - ln((b + 0.5) / ({clean} - b + 0.5))"
    counted = counted.where(f"a >= {MIN_DOCUMENTS}").withColumn("odds", F.expr(odds))
    counted = counted.withColumn("z", F.expr("odds / sqrt(1 / (a + 0.5) + 1 / (b + 0.5))"))
    chosen = counted.where(f"z >= {MIN_Z} AND odds >= {BINS[0]}").orderBy(F.desc("z"), "key").limit(LEXICON)
    return {row["key"]: sum(row["odds"] >= bound for bound in BINS) for row in chosen.select("key", "odds").collect()}


def evidence(token: str, lexicon: dict[str, int]) -> int:
    """The word's bin and the best bin of its beginnings as one number; 0 is no evidence."""
    keys = keys_of(token)
    if not keys:
        return 0
    best = max((lexicon.get(k, 0) for k in keys[1:]), default=0)
    return lexicon.get(keys[0], 0) * (len(BINS) + 1) + best


def _codes(text: str, lexicon: dict[str, int], known: dict[str, int]) -> list[int]:
    tokens = text.lower().split()
    found = list(map(known.get, tokens))
    if None in found:
        if len(known) > REMEMBERED:
            known.clear()
        for i, code in enumerate(found):
            if code is None:
                code = evidence(tokens[i], lexicon)
                if len(tokens[i]) <= 64:
                    known[tokens[i]] = code
                found[i] = code
    return found


#: The weights: word bins, beginning bins, bias, the moves 01, 10 and 11, and the first token's bias (all for toxic).
_N = len(BINS) + 1
_SIZE = 2 * _N + 5


def _emission(weights: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return weights[codes // _N] + weights[_N + codes % _N] + weights[2 * _N]


def _moves(weights: np.ndarray) -> np.ndarray:
    return np.exp(np.array([[0.0, weights[2 * _N + 1]], [weights[2 * _N + 2], weights[2 * _N + 3]]]))


def _gradient(weights, codes, labels, mask):
    """Gradient of the mean log-likelihood over segments of equal length (mask: real tokens)."""
    n, length = codes.shape
    moves, emit = _moves(weights), np.exp(np.clip(_emission(weights, codes), -30, 30))
    both = np.stack([np.ones_like(emit), emit], axis=2)
    start = np.array([1.0, math.exp(weights[2 * _N + 4])])
    alpha, beta = np.zeros((n, length, 2)), np.ones((n, length, 2))
    a = start * both[:, 0]
    alpha[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, length):
        a = (alpha[:, t - 1] @ moves) * both[:, t]
        alpha[:, t] = np.where(mask[:, t, None], a / a.sum(axis=1, keepdims=True), alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        b = (both[:, t + 1] * beta[:, t + 1]) @ moves.T
        beta[:, t] = np.where(mask[:, t + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
    post = alpha * beta
    post = (post / post.sum(axis=2, keepdims=True))[:, :, 1] * mask
    diff = labels * mask - post
    out = np.zeros(_SIZE)
    out[:_N] = np.bincount((codes // _N).ravel(), diff.ravel(), _N)
    out[_N : 2 * _N] = np.bincount((codes % _N).ravel(), diff.ravel(), _N)
    out[2 * _N] = diff.sum()
    pair = alpha[:, :-1, :, None] * moves * (both[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair = pair / pair.sum(axis=(2, 3), keepdims=True) * mask[:, 1:, None, None]
    seen = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            seen[i, j] = ((labels[:, :-1] == i) & (labels[:, 1:] == j) & mask[:, 1:]).sum()
    move = seen - pair.sum(axis=(0, 1))
    out[2 * _N + 1 : 2 * _N + 4] = move[0, 1], move[1, 0], move[1, 1]
    out[2 * _N + 4] = diff[:, 0].sum()
    return out / mask.sum()


class Chain:
    """Marginals of a fitted chain. Runs of tokens without evidence are one step."""

    def __init__(self, weights: np.ndarray):
        self.emit = np.exp(np.clip(_emission(weights, np.arange(_N * _N)), -30, 30)).tolist()
        self.start = math.exp(weights[2 * _N + 4])
        moves = _moves(weights)
        self.moves = moves.ravel().tolist()
        plain = moves * np.array([1.0, self.emit[0]])
        power, self.powers = np.eye(2), []
        for _ in range(512):
            self.powers.append((power / power.sum()).ravel().tolist())
            power = power @ plain
            power /= power.sum()

    def marginals(self, codes: list[int]) -> list[tuple[int, float]]:
        """(place, probability) of every token with evidence."""
        places = [i for i, code in enumerate(codes) if code]
        if not places:
            return []
        m00, m01, m10, m11 = self.moves
        powers, emit = self.powers, self.emit
        forward, last = [], -1
        x, y = 1.0, 0.0
        for place in places:
            gap = place - last - 1
            if last < 0:
                # The first token has no move before it; a plain first token starts the run.
                x, y = 1.0, self.start
                if gap:
                    y *= emit[0]
                    p = powers[min(gap - 1, 511)]
                    x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
                    x, y = x * m00 + y * m10, x * m01 + y * m11
            else:
                p = powers[min(gap, 511)]
                x, y = x * p[0] + y * p[2], x * p[1] + y * p[3]
                x, y = x * m00 + y * m10, x * m01 + y * m11
            y *= emit[codes[place]]
            total = x + y
            x, y = x / total, y / total
            forward.append((x, y))
            last = place
        out = []
        u, v = 1.0, 1.0
        after = len(codes)
        for place, (x, y) in zip(reversed(places), reversed(forward)):
            gap = after - place - 1
            p = powers[min(gap, 511)]
            if after < len(codes):
                e = emit[codes[after]]
                u, v = m00 * u + m01 * e * v, m10 * u + m11 * e * v
            u, v = p[0] * u + p[1] * v, p[2] * u + p[3] * v
            total = u + v
            u, v = u / total, v / total
            out.append((place, y * v / (x * u + y * v)))
            after = place
        return out[::-1]


def _features(marginals: list[tuple[int, float]], n_tokens: int) -> list[float]:
    total = sum(p for _, p in marginals)
    top = max((p for _, p in marginals), default=0.0)
    return [1.0, math.log1p(total), top, math.log((total + 0.05) / (n_tokens + 10)), math.log(n_tokens + 10)]


def _fit(lexicon: dict[str, int], weight_of: dict[bool, float]):
    """One task: the chain's weights, then those of the logistic regression. The input is bounded by TRAIN_PER_CLASS."""

    def fit(batches):
        known: dict[str, int] = {}
        sequences, classes = [], []
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                sequences.append(np.array(_codes(text.as_py() or "", lexicon, known), dtype=np.int64))
                classes.append(bool(toxic))
        pieces = [
            (s[at : at + SEGMENT], toxic) for s, toxic in zip(sequences, classes) for at in range(0, len(s), SEGMENT)
            if s[at : at + SEGMENT].any()
        ]
        weights = np.zeros(_SIZE)
        if pieces:
            codes, mask = np.zeros((len(pieces), SEGMENT), dtype=np.int64), np.zeros((len(pieces), SEGMENT), dtype=bool)
            labels = np.zeros((len(pieces), SEGMENT))
            for i, (piece, toxic) in enumerate(pieces):
                codes[i, : len(piece)], mask[i, : len(piece)] = piece, True
                labels[i, : len(piece)] = (piece > 0) & toxic
            first, second = np.zeros(_SIZE), np.zeros(_SIZE)
            batch = 4096
            for step in range(1, STEPS + 1):  # Adam, a block of segments in turn
                at = (step * batch) % max(1, len(pieces))
                some = np.arange(at, at + min(batch, len(pieces))) % len(pieces)
                slope = _gradient(weights, codes[some], labels[some], mask[some]) * SEGMENT - 1e-4 * weights
                first = 0.9 * first + 0.1 * slope
                second = 0.99 * second + 0.01 * slope**2
                weights = weights + 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        chain = Chain(weights)
        x = np.array([_features(chain.marginals(s.tolist()), len(s)) for s in sequences]).reshape(-1, 5)
        y = np.array(classes, dtype=float)
        share = np.array([weight_of[c] for c in classes])
        theta = np.zeros(5)
        for _ in range(30):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            h = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(5)
            theta = theta + np.linalg.solve(h, x.T @ (share * (y - p)) - 1e-2 * theta)
        yield pa.RecordBatch.from_arrays([pa.array([[*weights.tolist(), *theta.tolist()]])], names=["weights"])

    return fit


def _score(lexicon: dict[str, int], fitted: list[float]):
    def scored(batches):
        chain, theta = Chain(np.array(fitted[:_SIZE])), np.array(fitted[_SIZE:])
        known: dict[str, int] = {}
        for batch in batches:
            scores, counts, spans = [], [], []
            for text in batch.column(2):
                text = text.as_py() or ""
                codes = _codes(text, lexicon, known)
                marginals = chain.marginals(codes)
                z = float(np.dot(theta, _features(marginals, len(codes))))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                toxic = {place for place, p in marginals if p >= 0.5}
                counts.append(len(toxic))
                where = [f"{m.start()}:{m.end()}" for i, m in enumerate(re.finditer(r"\S+", text)) if i in toxic] if toxic else []
                spans.append(",".join(where))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(counts, pa.int64()), pa.array(spans, pa.string())],
                names=["doc_id", "held_out", "score", "predicted", "n_toxic_tokens", "spans"],
            )

    return scored


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_toxic_tokens and spans of toxic tokens (start:end, code points).

    `docs` needs doc_id and text, `labels` doc_id and toxic; other columns are ignored. Fitting uses labels of rows whose
    crc32(doc_id as text) mod 4 is not 2, at most about TRAIN_PER_CLASS of each class, equal texts once, and no other
    input than the text. Null texts count as empty and are scored like all others. Null labels are left out; of
    several labels of a document the highest counts. Without labels of both classes every score is the share of
    toxic ones (0 without any). Repeated rows give a row each.
    """
    held = Held(docs.sparkSession)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    usable = usable.where(fold != 2)
    sizes = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    keep = F.lit(False)
    for toxic, size in sizes.items():
        share = min(1.0, TRAIN_PER_CLASS / size)
        keep = keep | ((F.col("toxic") == toxic) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < round(1_000_000 * share)))
    chosen = held.table(usable.where(keep))
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "text"
    )
    train = every.join(chosen, "doc_id").where("text IS NOT NULL").groupBy(F.md5("text").alias("copy"))
    train = held.table(train.agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"))
    used = {row["toxic"]: row["count"] for row in train.groupBy("toxic").count().collect()}
    if len(used) < 2:
        rate = 1.0 if used.get(True) else 0.0
        lexicon, fitted = {}, [0.0] * _SIZE + [60.0 * rate - 30.0, 0.0, 0.0, 0.0, 0.0]
    else:
        lexicon = _lexicon(train, used[True], used[False])
        weight_of = {toxic: sizes[toxic] / used[toxic] for toxic in used}
        ordered = train.repartition(1).sortWithinPartitions(F.md5("text"))
        fitted = ordered.mapInArrow(_fit(lexicon, weight_of), FIT).head()["weights"]
    return every.mapInArrow(_score(lexicon, fitted), SCORED)
