"""Toxic spans by a linear-chain conditional random field over the words of a sentence.

Labels are given per document, so words get theirs first: a word is labelled toxic if it, or
how it begins, occurs in many toxic documents and hardly in others.  The field learns from
those words in their sentences; forward-backward marginals of all words of a document give
its score and the offending offsets.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Memo, carried, schema_with, texts_of

#: Letters of the beginnings that count as features beside the whole word.
BEGINNINGS = (4, 5, 6)
#: Added to the score of a word that ends its sentence, so that one number says both.
ENDS = 4096.0
_EDGES = re.compile(r"^\W+|\W+$")
_WORD = re.compile(r"\S+")


class Field(NamedTuple):
    """A trained field: weights by feature, states clean (0) and toxic (1)."""

    weights: dict[str, float]
    bias: float
    #: stay[a][b]: score of state b after state a.
    moves: tuple[tuple[float, float], tuple[float, float]]
    #: Of the document's score: constant, logarithm of expected toxic words, largest logit.
    score: tuple[float, float, float]


def features(word: str) -> list[str]:
    core = _EDGES.sub("", word).lower()
    return [f"={core}", *(core[:n] for n in BEGINNINGS if len(core) > n)]


def ends_sentence(word: str) -> bool:
    return word[-1] in ".!?" or (len(word) > 1 and word[-2] in ".!?")


def _chains(ends: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of sentences, longest first; a document's end ends its last one."""
    if not len(ends):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = ends.copy()
    last[np.cumsum(documents)[documents > 0] - 1] = True
    stops = np.flatnonzero(last) + 1
    starts = np.concatenate(([0], stops[:-1]))
    lengths = stops - starts
    order = np.argsort(-lengths, kind="stable")
    return starts[order], lengths[order]


def marginal_logits(
    emission: np.ndarray, starts: np.ndarray, lengths: np.ndarray, moves
) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of state toxic at each word given its sentence, and the forward log odds.

    All sentences advance together, one word at a time; log odds stand for the pair of
    forward (backward) sums, which keeps them in range.
    """
    (cc, ct), (tc, tt) = moves
    forward, backward = np.empty_like(emission), np.zeros_like(emission)
    alive = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    odds = np.empty(len(starts))
    for step, n in enumerate(alive):
        at = starts[:n] + step
        if step:
            odds = np.logaddexp(tt + odds[:n], ct) - np.logaddexp(tc + odds[:n], cc)
            odds += emission[at]
        else:
            odds = emission[at].copy()
        forward[at] = odds
    for step, n in enumerate(alive[1:]):
        # The step-th word from the end, of the sentences that have a word before it.
        at = starts[:n] + lengths[:n] - 1 - step
        odds = emission[at] + backward[at]
        backward[at - 1] = np.logaddexp(tt + odds, tc) - np.logaddexp(ct + odds, cc)
    return forward + backward, forward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def distinct_texts(texts: Sequence[str], labels: Sequence[int], signs: int = 4) -> tuple[list[str], list[int]]:
    """Texts without near copies of earlier ones: none shares one of its least shingle hashes."""
    seen: set[int] = set()
    kept: tuple[list[str], list[int]] = ([], [])
    for text, label in zip(texts, labels):
        words = text.split()
        hashes = {
            xxhash.xxh3_64_intdigest(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))
        }
        least = sorted(hashes)[:signs]
        if seen.isdisjoint(least):
            kept[0].append(text)
            kept[1].append(label)
        seen.update(least)
    return kept


def toxic_features(
    texts: Sequence[str], labels: Sequence[int], odds: float = 3.0, surprise: float = 10.0
) -> set[str]:
    """Features of more than three letters that are far more common in toxic documents.

    Their rate there is at least ``exp(odds)`` times that in others, and chance would give
    such a share with a probability of about ``exp(-surprise)`` at most.
    """
    totals = [labels.count(0), labels.count(1)]
    toxic_counts: Counter = Counter()
    for text, label in zip(texts, labels):
        if label:
            toxic_counts.update({f for word in set(text.split()) for f in features(word)})
    # Others are counted only where enough toxic documents have the feature.
    often = {f: n for f, n in toxic_counts.items() if n > 2 and len(f) > 3}
    clean_counts: Counter = Counter()
    for text, label in zip(texts, labels):
        if not label:
            clean_counts.update({f for word in set(text.split()) for f in features(word) if f in often})
    found = set()
    for f, toxic in often.items():
        clean = clean_counts[f]
        rate = math.log((toxic + 0.1) / (totals[1] + 1)) - math.log((clean + 0.1) / (totals[0] + 1))
        if rate >= odds:
            share = totals[1] / sum(totals)
            n = toxic + clean
            likely = toxic * math.log(toxic / (n * share))
            likely += clean * math.log(clean / (n * (1 - share))) if clean else 0.0
            if likely >= surprise:
                found.add(f)
    return found


def train_field(
    texts: Sequence[str],
    labels: Sequence[int],
    rounds: int = 40,
    decay: float = 2e-6,
    sentences: int = 40_000,
    longest: int = 64,
) -> Field | None:
    """Fits the field by gradient ascent on the words' likelihood; None without both classes.

    It learns from at most ``sentences`` sentences of at most ``longest`` words, half of them
    with a toxic word if there are so many; the document's score is fitted on whole texts.
    """
    texts, labels = distinct_texts(texts, labels)
    if not (0 in labels and 1 in labels):
        return None
    toxic = toxic_features(texts, labels)
    # 1 for a toxic word, and 2 more for one that ends its sentence.
    codes = Memo(lambda w: int(not toxic.isdisjoint(features(w))) + 2 * ends_sentence(w), 150_000)
    found = []
    for k, text in enumerate(texts):
        code = np.fromiter(map(codes.__getitem__, text.split()), np.int64)
        first, size = _chains(code >= 2, np.array([len(code)]))
        reach = np.concatenate(([0], np.cumsum(code % 2)))
        hit = reach[first + size] > reach[first]
        found.append(np.stack([np.full(len(first), k), first, size, hit]))
    found = np.concatenate(found, axis=1)
    random = np.random.default_rng(7)
    picked = [
        random.permutation(np.flatnonzero((found[3] == side) & (found[2] <= longest)))[: sentences // 2]
        for side in (1, 0)
    ]
    picked = found[:, np.sort(np.concatenate(picked))]
    names: dict[str, int] = {}
    vocabulary: dict[str, int] = {}
    rows, cols, tokens, last = [], [], [], (-1, [])
    for k, first, size in picked[:3].T.tolist():
        if last[0] != k:
            last = (k, texts[k].split())
        for word in last[1][first : first + size]:
            if word not in vocabulary:
                cols_of = [names.setdefault(f, len(names)) for f in features(word)]
                rows.extend([len(vocabulary)] * len(cols_of))
                cols.extend(cols_of)
            tokens.append(vocabulary.setdefault(word, len(vocabulary)))
    tokens, rows, cols, n_words = np.array(tokens), np.array(rows), np.array(cols), len(vocabulary)
    y = (np.fromiter(map(codes.__getitem__, vocabulary), np.int64) % 2).astype(float)[tokens]
    ends = np.zeros(len(tokens), dtype=bool)
    ends[np.cumsum(picked[2]) - 1] = True
    starts, lengths = _chains(ends, np.array([len(tokens)]))
    inside = np.ones(len(tokens), dtype=bool)
    inside[starts] = False
    after = np.flatnonzero(inside)

    # Clean is the reference state: weights, bias and three of four moves are free.
    weights, bias, moves = np.zeros(len(names)), -4.0, np.array([[0.0, 0.0], [0.0, 0.0]])
    step_w, step_o = np.zeros((2, len(names))), np.zeros((2, 5))
    for k in range(1, rounds + 1):
        emission = (np.bincount(rows, weights[cols], n_words) + bias)[tokens]
        logits, forward = marginal_logits(emission, starts, lengths, moves)
        p = _sigmoid(logits)
        error = y - p
        by_word = np.bincount(tokens, error, n_words)
        grad_w = np.bincount(cols, by_word[rows], len(names)) / len(tokens) - decay * weights
        # Pair marginals, by the forward odds of the word before and the marginal after.
        before = forward[after - 1]
        back = logits[after] - forward[after] + emission[after]
        joint = np.stack(
            [np.full(len(after), moves[0, 0]), moves[0, 1] + back, moves[1, 0] + before, moves[1, 1] + before + back]
        )
        joint = np.exp(joint - joint.max(axis=0))
        expected = (joint / joint.sum(axis=0)).sum(axis=1)
        a, b = y[after - 1], y[after]
        seen = np.array([((1 - a) * (1 - b)).sum(), ((1 - a) * b).sum(), (a * (1 - b)).sum(), (a * b).sum()])
        grad_o = np.append(seen - expected, error.sum()) / len(tokens)
        for step, grad in ((step_w, grad_w), (step_o, grad_o)):
            step[0] = 0.9 * step[0] + 0.1 * grad
            step[1] = 0.99 * step[1] + 0.01 * grad**2
        rate_1, rate_2 = 1 - 0.9**k, 1 - 0.99**k
        weights += 0.3 * step_w[0] / rate_1 / (np.sqrt(step_w[1] / rate_2) + 1e-9)
        move = 0.1 * step_o[0] / rate_1 / (np.sqrt(step_o[1] / rate_2) + 1e-9)
        moves += move[:4].reshape(2, 2)
        moves[0, 0] = 0.0
        bias += move[4]

    field = Field(
        {f: float(weights[i]) for f, i in names.items() if abs(weights[i]) > 1e-3},
        float(bias),
        tuple(map(tuple, moves.tolist())),
        (0.0, 0.0, 0.0),
    )
    scores = Memo(lambda word: _word_score(field, word), 150_000)
    x = [_document_terms(*_logits(field, scores, texts[i : i + 500])) for i in range(0, len(texts), 500)]
    return field._replace(score=_fit_logistic(np.concatenate(x), np.array(labels, dtype=float)))


def _document_terms(logits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Logarithm of the expected toxic words, and the largest logit, of each document."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    expected = np.bincount(owner, _sigmoid(logits), len(sizes))
    largest = np.full(len(sizes), -20.0)
    np.maximum.at(largest, owner, logits)
    return np.stack([np.log(expected + 1e-6), np.clip(largest, -20, 20)], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    for _ in range(30):
        p = _sigmoid(z @ beta)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, z.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -2, 2)
    return tuple(map(float, beta))


def learn_field(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 2000,
    longest: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Field | None:
    """Trains on a bounded sample of labelled documents, chosen by a hash of their id.

    At most ``per_class`` toxic documents and twice as many others, of at most ``longest``
    characters, go to the one task that trains; only the field comes to the driver.  Labels
    other than 0 and 1 and NULL ids are not used.  None if a class has no document.
    """
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter("id IS NOT NULL")
    ids = None
    for label, n in ((0, 2 * per_class), (1, per_class)):
        some = wanted.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(n)
        ids = some if ids is None else ids.unionByName(some)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & (F.length("text") <= longest)
    )
    # At most 3 * per_class ids are broadcast.
    sample = texts.join(F.broadcast(ids), "id").orderBy(F.xxhash64("id"), "id", "text").limit(3 * per_class)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, marks = [], []
        for batch in batches:
            given += batch.column("text").to_pylist()
            marks += batch.column("label").to_pylist()
        field = train_field(given, marks)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(field)])], ["field"])

    rows = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(train, "field string")
    found = [field for row in rows.collect() if (field := json.loads(row["field"]))]
    return Field(*found[0]) if found else None


def tag_toxicity(
    docs: DataFrame,
    field: Field | None,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
    clean_only: bool = False,
) -> DataFrame:
    """The columns ``keep``, then ``score, predicted, spans`` of each row, map-only.

    ``spans`` are the character offsets ``(start, end)`` of words that are rather toxic than
    not; ``predicted`` is 1 from a score of 0.5 on.  Whole texts are read.  NULL and empty
    texts get the score of a text without any toxic word, without a field every score is 0.
    NULL or repeated ids change nothing, and of other columns only ``keep`` is read.  With
    ``clean_only`` the rows predicted 0 come back, with the columns ``keep`` alone.
    """
    rows, names, text_name = carried(docs, keep, text_col, once=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Memo(lambda word: _word_score(field, word), 150_000) if field else None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = texts_of(part.column(text_name))
                score, spans = _tag(field, scores, texts) if field else (np.zeros(len(texts)), [[] for _ in texts])
                if clean_only:
                    yield part.select(names).filter(pa.array(score < 0.5))
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        *map(part.column, names),
                        pa.array(score, pa.float64()),
                        pa.array((score >= 0.5).astype(np.int32)),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ],
                    [*names, "score", "predicted", "spans"],
                )

    found = "score double, predicted int, spans array<struct<start:int,end:int>>"
    kept = [F.col(n).alias(c) for n, c in zip(names, keep)]
    if clean_only:
        return rows.mapInArrow(run, schema_with(rows, names, "")).select(*kept)
    tagged = rows.mapInArrow(run, schema_with(rows, names, found))
    return tagged.select(*kept, "score", "predicted", "spans")


def _word_score(field: Field, word: str) -> float:
    weight = field.weights.get
    score = field.bias + sum(weight(f, 0.0) for f in features(word))
    return score + ENDS if ends_sentence(word) else score


def _logits(field: Field, scores: Memo, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Marginal logits of all words of some texts, and how many words each has."""
    words = [text.split() for text in texts]
    sizes = np.array([len(w) for w in words])
    emission = np.fromiter(map(scores.__getitem__, chain.from_iterable(words)), float, sizes.sum())
    ends = emission > ENDS / 2
    emission[ends] -= ENDS
    return marginal_logits(emission, *_chains(ends, sizes), field.moves)[0], sizes


def _tag(field: Field, scores: Memo, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
    logits, sizes = _logits(field, scores, texts)
    c, a, b = field.score
    x = _document_terms(logits, sizes)
    spans: list[list[dict]] = [[] for _ in texts]
    borders = np.concatenate(([0], np.cumsum(sizes)))
    hits = np.flatnonzero(logits > 0)
    owners = np.searchsorted(borders, hits, side="right") - 1
    for owner in np.unique(owners):
        wanted = set((hits[owners == owner] - borders[owner]).tolist())
        spans[owner] = [
            {"start": m.start(), "end": m.end()}
            for i, m in enumerate(_WORD.finditer(texts[owner]))
            if i in wanted
        ]
    return _sigmoid(c + a * x[:, 0] + b * x[:, 1]), spans
