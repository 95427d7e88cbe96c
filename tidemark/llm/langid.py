"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is the average of the embeddings of its subwords: byte runs of two to four bytes of the lower-cased text, white space
being one boundary byte, hashed into ``BUCKETS``.  Embeddings and the softmax layer are trained by stochastic gradient descent
in numpy on a bounded sample of labelled rows.  As the layer is linear, the average of embeddings times the layer is the
average of per-bucket logits, so predicting needs one small table (buckets x languages).

On rows kept out of training a temperature is fitted to the softmax, and a rejection threshold such that 99 of 100 right
predictions pass; ``accepted`` tells whether a prediction reaches it.

Defined results: ``und`` with score 0 for a null text or one without a letter; if no row has a label, all are ``und``;
repeated rows get equal results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import joined_bytes, mix, text_slices

#: Labelled rows per language that training may read, and their largest size in bytes.
SAMPLE_ROWS = 700
SAMPLE_BYTES = 20_000
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 6
RATE = 0.5
RUNS = (2, 3, 4)
UNKNOWN = "und"
LETTER = r"\p{L}"

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[0x09:0x0E] = 0x20


def subwords(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each run length: the buckets of all runs of the joined texts, and which of them stay inside one text."""
    data = _PLAIN[raw].astype(np.uint64)
    last = np.repeat(offsets[1:], np.diff(offsets))
    for n in RUNS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        run = np.full(m, n, np.uint64)
        for i in range(n):
            run = (run << np.uint64(8)) | data[i : i + m]
        yield (mix(run) % np.uint64(BUCKETS)).astype(np.int32), np.arange(n, n + m) <= last[:m]


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    least: float

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each of the joined texts."""
        sums, seen = np.zeros((len(offsets) - 1, len(self.languages))), np.zeros(len(offsets) - 1)
        full = np.flatnonzero(np.diff(offsets) > 0)
        for buckets, inside in subwords(raw, offsets):
            starts = offsets[:-1][full]
            full_now = full[starts < len(buckets)]
            starts = starts[starts < len(buckets)]
            if len(starts):
                for k in range(len(self.languages)):
                    values = self.logits[:, k][buckets]
                    values[~inside] = 0
                    sums[full_now, k] += np.add.reduceat(values, starts)
                seen[full_now] += np.add.reduceat(inside.astype(np.float64), starts)
        z = (sums / np.maximum(seen, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = joined_bytes(pa.array([text]))
    held = [b[i] for b, i in subwords(raw, offsets)]
    found, count = np.unique(np.concatenate(held) if held else np.zeros(0, np.int32), return_counts=True)
    return found, count / max(1, count.sum())


def train(texts: list[str], labels: list[str], seed: int = 7) -> Model | None:
    """Fit on labelled texts; every fifth one calibrates temperature and rejection."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rows = [(*_sparse(t), languages.index(g)) for t, g in zip(texts, labels, strict=True)]
    fit = [r for k, r in enumerate(rows) if k % 5] or rows
    held = [r for k, r in enumerate(rows) if not k % 5]
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    layer = random.normal(0, 0.1, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    total, done = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(fit)):
            buckets, share, label = fit[k]
            rate = RATE * (1 - done / total)
            done += 1
            average = share @ embeddings[buckets]
            z = average @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            down = layer @ p
            layer -= rate * np.outer(average, p)
            bias -= rate * 0.1 * p
            # a bucket's share of one text is small, so its step is taken relative to the largest one
            embeddings[buckets] -= rate * (share / share.max(initial=1e-12))[:, None] * down
    logits = embeddings @ layer
    z = np.array([share @ logits[buckets] + bias for buckets, share, _ in held]).reshape(-1, len(languages))
    y = np.array([label for *_, label in held], int)

    def likelihood(temperature: float) -> float:
        s = z / temperature
        s = s - s.max(1, keepdims=True)
        return float((s[np.arange(len(y)), y] - np.log(np.exp(s).sum(1))).mean()) if len(y) else 0.0

    temperature = max((2.0**k for k in np.arange(-4, 4.25, 0.25)), key=likelihood)
    s = np.exp((z - z.max(1, keepdims=True)) / temperature) if len(y) else np.zeros((0, 1))
    best = s.max(1) / s.sum(1) if len(y) else np.zeros(0)
    right = best[z.argmax(1) == y] if len(y) else best
    least = float(np.quantile(right, 0.01)) if len(right) else 0.0
    return Model(languages, logits, bias, float(temperature), least)


def sample(docs: DataFrame, fold: Column, rows: int = SAMPLE_ROWS) -> tuple[list[str], list[str]]:
    """Bounded labelled texts and their languages, the same at every run: about ``rows`` per language, by hash of doc_id.

    Languages are counted over the whole table; each is sampled at its own rate.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & fold)
    known = known.filter(F.octet_length("text").between(1, SAMPLE_BYTES) & F.col("text").rlike(LETTER))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    rate = F.element_at(F.create_map(*[F.lit(x) for g, c in sorted(counts.items()) for x in (g, min(1.0, rows / c))]), F.col("lang"))
    found = known.filter(place < rate).orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    return [r["text"] for r in found], [r["lang"] for r in found]


def predict_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``lang_pred, score, accepted``; reads the text alone, does not shuffle."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    names = ["row", "lang_pred", "score", "accepted"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        held = pickle.loads(shared.value)
        letter = regex.compile(LETTER)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = part.column("text")
                found = held.predict(*joined_bytes(texts))
                best, score = found.argmax(1), found.max(1).round(6)
                written = np.array([t is not None and letter.search(t) is not None for t in texts.to_pylist()], bool)
                guess = [held.languages[k] if w else UNKNOWN for k, w in zip(best, written, strict=True)]
                score = np.where(written, score, 0.0)
                accepted = written & (score >= held.least)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(guess), pa.array(score), pa.array(accepted)], names)

    out = rows.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "accepted": F.lit(False)}).select(*names)
    return rows.mapInArrow(predict, out.schema)
