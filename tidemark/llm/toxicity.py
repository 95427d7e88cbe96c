"""Toxicity by compression distance: two zstandard dictionaries, window lengths compared, thresholds calibrated.

Training reads a bounded sample of labelled rows.  The ordinary dictionary is trained by zstandard on windows of ordinary
texts.  The toxic one has the same content and, nearest to the data, what toxic text repeats and ordinary text does not:
byte runs inside words, counted once per distinct context so that copied documents count once.  The ordinary dictionary
ends with a filler of the same length, so a window without such runs compresses to the same length with both, and the
difference of lengths measures toxic content alone.

A text is cut into windows of about ``WINDOW`` bytes at spaces.  From the differences of its windows come a few features
(share of windows at or above each threshold, the largest, the mean); a logistic model on rows that the dictionaries have
not seen turns them into a score, shifted so that the threshold with the best F1 there is a score of 0.3.

Scoring reads whole texts and nothing but the text.  Defined results: null and empty texts have one empty window; without
toxic or without ordinary labelled rows every score is 0; repeated rows get equal scores.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import held_state, text_slices

#: Labelled rows that training may read, by label, and their largest size in bytes.
SAMPLE_TOXIC = 1_200
SAMPLE_ORDINARY = 2_400
SAMPLE_BYTES = 20_000

WINDOW = 64
ORDINARY_BYTES = 8_000
TOXIC_BYTES = 2_000
#: A run must stand in so many contexts, and so many times as often per toxic text as per ordinary text.
LEAST_CONTEXTS, LEAST_RATIO, LEAST_Z = 5, 8.0, 3.5
STEPS = np.array([2, 3, 4, 5, 6, 8])
THRESHOLD = 0.3

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[ord("A") : ord("Z") + 1] += 32
_PLAIN[0x09:0x0E] = 0x20


def plain_bytes(text: str | None) -> np.ndarray:
    """A text's UTF-8 bytes in lower case with plain spaces, one before and one after."""
    return _PLAIN[np.frombuffer(f" {text or ''} ".encode(errors="replace"), np.uint8)]


def windows(text: np.ndarray, size: int = WINDOW) -> list[bytes]:
    """Consecutive windows of at most ``size`` bytes, ended at the last space of their second half if there is one."""
    data, out, at = text.tobytes(), [], 0
    while at < len(data):
        end = min(len(data), at + size)
        if end < len(data):
            space = data.rfind(b" ", at + size // 2, end)
            end = space if space > 0 else end
        out.append(data[at:end])
        at = end
    return out


def _runs(texts: list[np.ndarray], n: int, among: np.ndarray | None = None) -> np.ndarray:
    """Distinct (run, context) pairs: byte runs of length n without an inner space, with three bytes on each side."""
    held = []
    for text in texts:
        data = np.concatenate([[0x20, 0x20], text, [0x20, 0x20]]).astype(np.uint64)
        m = len(data) - n - 5
        if m <= 0:
            continue
        run, around, inner = np.zeros(m, np.uint64), np.zeros(m, np.uint64), np.ones(m, bool)
        for i in range(n):
            part = data[3 + i : 3 + i + m]
            run = (run << np.uint64(8)) | part
            if 0 < i < n - 1:
                inner &= part != 0x20
        for i in (0, 1, 2, n + 3, n + 4, n + 5):
            around = (around << np.uint64(8)) | data[i : i + m]
        if among is not None and len(among):
            at = np.minimum(np.searchsorted(among, run), len(among) - 1)
            inner &= among[at] == run
        held.append(np.unique(np.stack([run[inner], around[inner]], 1), axis=0))
    return np.unique(np.concatenate(held), axis=0) if held else np.zeros((0, 2), np.uint64)


def _in_context(run: bytes, around: int) -> bytes:
    sides = around.to_bytes(6, "big")
    return sides[:3] + run + sides[3:]


def _meet(run: bytes, text: bytes) -> bool:
    """Whether a run stands in a text or reaches into it from either side with three bytes or more."""
    return run in text or any(text.startswith(run[-k:]) or text.endswith(run[:k]) for k in range(3, len(run)))


def toxic_runs(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> bytes:
    """The toxic dictionary's own content, the most telling run last."""
    found = []
    for n in (5, 6, 8):
        pairs = _runs(toxic, n)
        runs, first, seen = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        enough = seen >= LEAST_CONTEXTS
        runs, first, seen = runs[enough], first[enough], seen[enough]
        if not len(runs):
            continue
        others, other_seen = np.unique(_runs(ordinary, n, among=runs)[:, 0], return_counts=True)
        count = np.zeros(len(runs))
        count[np.searchsorted(runs, others)] = other_seen
        p, q = seen / len(toxic), (count + 0.5) / len(ordinary)
        z = (p - q) / np.sqrt(p / len(toxic) + q / len(ordinary))
        for k in np.flatnonzero((z > LEAST_Z) & (p / q > LEAST_RATIO)):
            run = int(runs[k]).to_bytes(n, "big")
            found.append((round(float(z[k]), 6), run, pairs[first[k] : first[k] + seen[k], 1]))
    chosen: list[bytes] = []
    for _, run, arounds in sorted(found, key=lambda f: (-f[0], f[1])):
        if sum(map(len, chosen)) + len(run) > TOXIC_BYTES:
            break
        # what a chosen run is part of, or reaches into, is told by that run already
        told = sum(any(_meet(c.strip(), text) for c in chosen) for text in (_in_context(run, int(a)) for a in arounds))
        if 2 * told < len(arounds):
            chosen.append(run)
    whole = b"\n".join(t.tobytes() for t in toxic)
    return b"".join(reversed([_extended(run, whole) for run in chosen]))


def _extended(run: bytes, text: bytes, most: int = 16) -> bytes:
    """A run with the neighbouring bytes that most of its occurrences in text share, within its word."""
    for side in (1, -1):
        while len(run) < most and not (run[-1:] if side == 1 else run[:1]).isspace():
            pattern = re.escape(run) + b"(.)" if side == 1 else b"(.)" + re.escape(run)
            seen = Counter(re.findall(pattern, text, re.S))
            byte, count = max(seen.items(), key=lambda x: (x[1], x[0]), default=(b"", 0))
            if 10 * count < 6 * seen.total() or not count:
                break
            run = run + byte if side == 1 else byte + run
    return run


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray
    scale: np.ndarray

    def _compressor(self, content: bytes):
        import zstandard

        fitted = zstandard.ZstdCompressionParameters.from_level(
            3, source_size=WINDOW, dict_size=len(content), strategy=zstandard.STRATEGY_GREEDY, min_match=5, write_content_size=0, write_dict_id=0
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=fitted)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def open(self) -> Model:
        self._toxic, self._ordinary = self._compressor(self.toxic), self._compressor(self.ordinary)
        return self

    def features(self, text: str | None) -> np.ndarray:
        cut = windows(plain_bytes(text))
        a, b = self._toxic.compress, self._ordinary.compress
        gain = np.array([len(b(w)) - len(a(w)) for w in cut])
        share = (gain[:, None] >= STEPS).mean(0)
        peak = np.minimum(np.sort(gain)[-3:], 16).sum() / 48
        return np.concatenate([share, np.sqrt(share), [peak, gain.mean(), np.log1p(len(cut)) / 10, 1.0]])

    def score(self, features: np.ndarray) -> float:
        z = float((features / self.scale) @ self.weights)
        return round(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), 9)


def train(toxic: list[str], ordinary: list[str]) -> Model | None:
    """Fit dictionaries and thresholds on sampled texts; None if one side is missing."""
    import zstandard

    if not toxic or not ordinary:
        return None
    bad, good = [plain_bytes(t) for t in toxic], [plain_bytes(t) for t in ordinary]
    bad_fit, good_fit = bad[: -(len(bad) // 3) or None], good[: -(len(good) // 3) or None]
    own = toxic_runs(bad_fit, good_fit)
    samples = [w for t in good_fit for w in windows(t, 256)]
    try:
        shared = zstandard.train_dictionary(2 * ORDINARY_BYTES, samples[:20_000], level=3).as_bytes()[-ORDINARY_BYTES:]
    except zstandard.ZstdError:  # too few samples to train on
        shared = b"".join(samples)[:ORDINARY_BYTES] or b" " * 8
    filler = (bytes(range(128, 256)) * (len(own) // 128 + 1))[: len(own)]
    model = Model(shared + own, shared + filler, np.zeros(0), np.ones(1)).open()
    held_bad, held_good = toxic[len(bad_fit) :] or toxic, ordinary[len(good_fit) :] or ordinary
    x = np.array([model.features(t) for t in [*held_bad, *held_good]])
    y = np.array([1.0] * len(held_bad) + [0.0] * len(held_good))
    model.scale = np.maximum(np.abs(x).max(0), 1e-6)
    x = x / model.scale
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 0.05 * w)
    z = x @ w
    best = max(np.unique(z), key=lambda c: (2 * y[z >= c].sum() / ((z >= c).sum() + y.sum()), c))
    below = z[z < best]
    cut = (best + below.max()) / 2 if len(below) else best
    w[-1] += (np.log(THRESHOLD / (1 - THRESHOLD)) - cut) * model.scale[-1]
    model.weights = w
    return model


def sample(docs: DataFrame, labels: DataFrame, fold: Column) -> tuple[list[str], list[str]]:
    """Bounded labelled texts (toxic, ordinary), the same at every run: the rows with the smallest hashes of doc_id."""
    known = labels.select("doc_id", "toxic").filter("toxic IN (0, 1)").dropDuplicates(["doc_id"]).filter(fold)
    small = docs.select("doc_id", "text").filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    rows = small.join(known, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    found = []
    for label, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY)):
        ids = rows.filter(F.col("toxic") == label).select("h", "doc_id").orderBy("h", "doc_id").limit(most)
        found.append([r["doc_id"] for r in ids.collect()])
    wanted = small.filter(F.col("doc_id").isin(found[0] + found[1])) if found[0] + found[1] else small.limit(0)
    texts = {r["doc_id"]: r["text"] for r in wanted.orderBy("doc_id", F.desc("text")).collect()}
    return [texts[i] for i in found[0]], [texts[i] for i in found[1]]


def held_model(pickled: bytes) -> Model:
    """A worker's model, opened once."""
    return held_state(("toxicity", pickled), lambda: pickle.loads(pickled).open())


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and ``score`` (0 to 1; higher: label 1 is likelier).  No shuffle."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    if model is None:
        return rows.select("row", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = held_model(shared.value)
        for batch in batches:
            for part in text_slices(batch, "text"):
                scores = [held.score(held.features(t)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))
