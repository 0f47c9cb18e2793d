"""Operator 9: a quality classifier that labels lines with a linear-chain conditional random field.

Every line is good or bad. Its features and those of the lines beside it give the states' potentials, and a
2x2 matrix those of neighbouring states. Forward-backward gives each line's probability of being good; their
mean, weighted by the lines' lengths, is mapped to the document's score."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, flat_bytes, slices, span_hashes, word_spans

#: Labelled documents that the model is fitted on at most (those with the smallest hashes of their ids).
TRAIN_DOCS = 3000
#: Lines of a document in that sample at most: longer ones are left out of it (features take 160 bytes a line).
TRAIN_LINES = 500
#: Steps and step size of the fit, and the weight of the squared parameters.
STEPS, RATE, PENALTY = 150, 0.05, 1e-4

_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
_CLASSES = {
    "upper": np.isin(np.arange(256), np.arange(65, 91)), "lower": np.isin(np.arange(256), np.arange(97, 123)), "digit": np.isin(np.arange(256), np.arange(48, 58)),
    "space": _SPACE, "beyond": np.arange(256) >= 0x80, "stop": np.isin(np.arange(256), list(b".,;:")), "mark": np.isin(np.arange(256), list(b"!?")),
    "sign": np.isin(np.arange(256), list(b"#$%&*+=<>^~@\\")), "bar": np.isin(np.arange(256), list(b"|_-/")), "bracket": np.isin(np.arange(256), list(b"()[]{}\"'`")),
}


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of every text (lines end at line feeds; an empty text is one empty line), the
    lines' lengths in bytes, and the index of each text's first line (one more entry than texts)."""
    flat, offs = flat_bytes(texts)
    feeds = np.flatnonzero(flat == 10)
    per_text = np.searchsorted(feeds, offs[1:]) - np.searchsorted(feeds, offs[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(per_text)])
    # a text's first line starts at its offset, the others after a feed; a line ends before the next feed or at the text's end
    start = np.empty(first[-1], np.int64)
    is_first = np.zeros(first[-1], bool)
    is_first[first[:-1]] = True
    start[is_first], start[~is_first] = offs[:-1], feeds + 1
    end = np.empty_like(start)
    is_last = np.zeros(first[-1], bool)
    is_last[first[1:] - 1] = True
    end[is_last], end[~is_last] = offs[1:], feeds
    size = end - start
    some = np.maximum(size, 1)
    cols = []
    for marks in _CLASSES.values():
        total = np.concatenate([[0], np.cumsum(marks[flat])])
        cols.append((total[end] - total[start]) / some)
    s, e, _ = word_spans(flat, offs, ~_SPACE)
    h = span_hashes(flat, s, e) if len(s) else np.zeros(0, np.uint64)
    line = np.searchsorted(start, s, side="right") - 1
    # equal starts: empty lines before this one
    n_words = np.bincount(line, minlength=len(start)).astype(float)
    words = np.maximum(n_words, 1)

    def distinct(keys, at):
        order = np.lexsort((keys, at))
        k, a = keys[order], at[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (a[1:] != a[:-1])
        return np.bincount(a[new], minlength=len(start))

    cols.append(distinct(h, line) / words)
    with np.errstate(over="ignore"):
        pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] if len(h) else h
    same = line[:-1] == line[1:] if len(h) else np.zeros(0, bool)
    pairs = np.bincount(line[:-1][same], minlength=len(start)) if len(h) else np.zeros(len(start))
    cols.append(np.where(pairs > 0, distinct(pair[same], line[:-1][same]) / np.maximum(pairs, 1), 1.0) if len(h) else np.ones(len(start)))
    cols.append((np.bincount(line[:-1][same & (h[:-1] == h[1:])], minlength=len(start)) if len(h) else np.zeros(len(start))) / words)
    length = e - s
    mean = np.bincount(line, weights=length, minlength=len(start)) / words
    cols += [mean, np.sqrt(np.maximum(np.bincount(line, weights=length**2, minlength=len(start)) / words - mean**2, 0)), np.log1p(size), np.log1p(n_words)]
    upper, lower = _CLASSES["upper"], _CLASSES["lower"]
    cols.append(np.bincount(line, weights=(upper[flat[s]] & (length > 1)).astype(float) if len(s) else None, minlength=len(start)) / words)
    cols.append(np.bincount(line, weights=(~(upper | lower | (np.arange(256) >= 0x80))[flat[e - 1]]).astype(float) if len(s) else None, minlength=len(start)) / words)
    return np.stack(cols, 1), size, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after (zeros at the ends), and a constant."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.concatenate([x, before, after, np.ones((len(x), 1))], 1)


def forward_backward(node: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Marginals of the two states of each line, expected transitions, and the log of each text's sum over
    paths. node: log potentials, a row a line; all texts that are long enough advance together."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    lens, at = n[order], first[:-1][order]
    alive = lambda t: int(np.searchsorted(-lens, -t, side="left"))  # noqa: E731  texts with more than t lines
    top = int(lens[0]) if len(lens) else 0
    alpha, beta = np.zeros_like(node), np.zeros_like(node)
    for t in range(top):
        k = alive(t)
        row = at[:k] + t
        alpha[row] = node[row] if t == 0 else node[row] + np.logaddexp(alpha[row - 1, 0, None] + trans[0], alpha[row - 1, 1, None] + trans[1])
    for t in range(top - 2, -1, -1):
        k = alive(t + 1)
        row = at[:k] + t
        on = node[row + 1] + beta[row + 1]
        beta[row] = np.logaddexp(on[:, 0, None] + trans[:, 0], on[:, 1, None] + trans[:, 1])
    end = first[1:] - 1
    log_z = np.logaddexp(alpha[end, 0], alpha[end, 1])
    line_z = np.repeat(log_z, n)
    p = np.exp(alpha + beta - line_z[:, None])
    inner = np.ones(len(node), bool)
    inner[end] = False
    row = np.flatnonzero(inner)
    pairs = np.exp(alpha[row][:, :, None] + trans[None] + (node[row + 1] + beta[row + 1])[:, None, :] - line_z[row][:, None, None]).sum(0)
    return p, pairs, log_z


@dataclass(frozen=True)
class LineCRF:
    """A fitted model. mean, scale: of the features; weights: of state good against bad; trans: of state
    pairs; stretch, shift: from the logit of the weighted mean to that of the score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    stretch: float
    shift: float

    def _line_good(self, x, first):
        score = with_neighbours((x - self.mean) / self.scale, first) @ self.weights
        return forward_backward(np.stack([np.zeros_like(score), score], 1), self.trans, first)[0][:, 1]

    def raw(self, x, size, first) -> np.ndarray:
        """Logit of the mean probability of a text's lines to be good, weighted by their lengths."""
        good, w = self._line_good(x, first), size + 1.0
        m = np.add.reduceat(good * w, first[:-1]) / np.add.reduceat(w, first[:-1])
        m = np.clip(m, 1e-6, 1 - 1e-6)
        return np.log(m / (1 - m))

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        x, size, first = line_features(texts)
        return 1 / (1 + np.exp(-(self.stretch * self.raw(x, size, first) + self.shift)))


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> LineCRF:
    """Maximum conditional likelihood, each line taking the label of its document (a document counts by its
    number of lines, at most 20 of them). With one label alone, or none, the scores are that label's share."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    if len(np.unique(label)) < 2:
        share = float(np.clip(label.mean() if len(label) else 0.5, 0.01, 0.99))
        return LineCRF(mean, scale, np.zeros(3 * x.shape[1] + 1), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    z, n = with_neighbours((x - mean) / scale, first), np.diff(first)
    y, weight = np.repeat(label, n), np.repeat(np.minimum(n, 20) / n, n)
    params = np.zeros(z.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    seen = np.zeros((2, 2))
    for k in (0, 1):
        seen[k, k] = (n[label == k] - 1).sum()
    for step in range(1, STEPS + 1):
        s = z @ params[:-4]
        p, pairs, _ = forward_backward(np.stack([np.zeros_like(s), s], 1), params[-4:].reshape(2, 2), first)
        grad = np.concatenate([z.T @ ((p[:, 1] - y) * weight) / len(z), (pairs - seen).ravel() / len(z)]) + PENALTY * params
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = LineCRF(mean, scale, params[:-4], params[-4:].reshape(2, 2), 1.0, 0.0)
    r, a, b = model.raw(x, size, first), 1.0, 0.0
    for _ in range(200):  # two parameters of a logistic curve
        q = 1 / (1 + np.exp(-(a * r + b)))
        a, b = a - 0.05 * (np.mean((q - label) * r) + 1e-3 * (a - 1)), b - 0.2 * np.mean(q - label)
    return LineCRF(mean, scale, model.weights, model.trans, float(max(a, 1e-3)), float(b))


def _remainder(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", limit: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> LineCRF:
    """Fit on at most `limit` labelled documents for which crc32(id) mod 3 is not 1, whole texts each. Features
    are made where the rows are; the driver gets those of the sample alone, at most `limit` times `max_lines` lines
    of 160 bytes, as documents of more lines are left out of the sample. Ids with several labels take the smallest,
    those on several rows the smallest text; null ids, null labels and other labels than 0 and 1 are left out. An
    empty table, of documents or of labels, gives a model that scores every text 0.5."""
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & (_remainder(id_col) != 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(limit)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chosen = rows.filter(F.size(F.split("text", "\n")) <= max_lines).join(F.broadcast(sample), "id")  # the sample has at most `limit` rows
    chosen = chosen.groupBy("id").agg(F.first("label").alias("label"), F.min("text").alias("text")).select("id", "label", "text")

    def features(batches):
        for b in slices(batches, "text"):
            x, size, first = line_features(b.column("text"))
            n = x.shape[1]
            cut = [(x[lo:hi].astype("<f8").tobytes(), size[lo:hi].astype("<i8").tobytes()) for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array([c[0] for c in cut], pa.binary()), pa.array([c[1] for c in cut], pa.binary()), pa.array([n] * len(cut), pa.int32())], names=["id", "label", "x", "size", "n"])

    kind = f"id {rows.schema['id'].dataType.simpleString()}, label int, x binary, size binary, n int"
    got = sorted(chosen.mapInArrow(features, kind).collect(), key=lambda r: (r.id, bytes(r.x)))
    n = got[0].n if got else len(_CLASSES) + 9
    x = np.frombuffer(b"".join(bytes(r.x) for r in got), "<f8").reshape(-1, n)
    size = np.frombuffer(b"".join(bytes(r.size) for r in got), "<i8")
    first = np.concatenate([[0], np.cumsum([len(r.size) // 8 for r in got])]).astype(np.int64)
    return fit(x, size, first, np.array([r.label for r in got], float))


def quality_score(model: LineCRF, text_col: str = "text") -> Column:
    """The score of a text (null: empty) as a column, from 0 (bad) to 1 (good)."""

    def score(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        return pd.Series(np.concatenate([model.scores(b.column("text")) for b in slices([batch], "text")] or [np.zeros(0)]))

    return F.pandas_udf(score, "double")(F.coalesce(F.col(text_col), F.lit("")))


def classify(docs: DataFrame, model: LineCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out (crc32(id) mod 3 is 1; false for a null id), score, predicted (1 if score >= 0.5).

    A null or empty text is one empty line and gets a score as such; rows stay as they are; no shuffle."""
    bounded_batches(docs.sparkSession)
    scored = docs.select(F.col(id_col), F.coalesce(_remainder(id_col) == 1, F.lit(False)).alias("held_out"), quality_score(model, text_col).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
