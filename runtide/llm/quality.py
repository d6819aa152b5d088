"""Quality scores by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtide.llm.shared import SPACE_BYTE, slices, text_buffers, with_columns, words

#: Bytes of a passage. Every byte of a text lies in exactly one passage; the last one is shorter.
PASSAGE_BYTES = 512
_CLASSES = (
    np.isin(np.arange(256), range(97, 123)),
    np.isin(np.arange(256), range(65, 91)),
    np.isin(np.arange(256), range(48, 58)),
    np.arange(256) == 32,
    np.arange(256) == 10,
    np.isin(np.arange(256), [44, 46]),
    np.arange(256) == 33,
    np.arange(256) == 124,
    np.isin(np.arange(256), [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ",.!|"]),
    np.arange(256) >= 128,
)
FEATURES = len(_CLASSES) + 5


def _encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the n + 1 passage offsets; an empty text has one empty passage."""
    sizes = np.diff(offsets)
    counts = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    bags = np.concatenate(([0], np.cumsum(counts)))
    within = np.arange(bags[-1]) - np.repeat(bags[:-1], counts)
    begin = np.repeat(offsets[:-1], counts) + within * PASSAGE_BYTES
    length = np.minimum(PASSAGE_BYTES, np.repeat(offsets[1:], counts) - begin)
    out = np.zeros((bags[-1], FEATURES), np.float32)
    share = np.maximum(length, 1)
    for k, kind in enumerate(_CLASSES):
        total = np.concatenate(([0], np.cumsum(kind[data], dtype=np.int64)))
        out[:, k] = (total[begin + length] - total[begin]) / share
    h, start, _, of_text = words(data, offsets, ~SPACE_BYTE, lower=False)
    text = np.repeat(np.arange(len(sizes)), np.diff(of_text))
    passage = bags[text] + (start - offsets[text]) // PASSAGE_BYTES
    n = np.bincount(passage, minlength=bags[-1])
    # Distinct words of a passage: sort hashes below the passage's number and count the changes.
    key = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=bags[-1])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    some = np.maximum(n, 1)
    k = len(_CLASSES)
    out[:, k] = distinct / some
    out[:, k + 1] = np.bincount(passage[again], minlength=bags[-1]) / some
    out[:, k + 2] = np.minimum(length / some, 40) / 10
    out[:, k + 3] = length / PASSAGE_BYTES
    out[:, k + 4] = n == 0
    return out, bags


def encode_passages(data: np.ndarray, offsets: np.ndarray):
    """(first text, features, bags) for runs of texts that fit a slice; a longer text is encoded in several steps."""
    step = 2048 * PASSAGE_BYTES
    for a, b in slices(offsets, step):
        at, end = int(offsets[a]), int(offsets[b])
        if end - at <= step:
            yield a, *_encode(data[at:end], offsets[a : b + 1] - at)
            continue
        parts = [_encode(data[k : min(k + step, end)], np.array([0, min(step, end - k)]))[0] for k in range(at, end, step)]
        whole = np.concatenate(parts)
        yield a, whole, np.array([0, len(whole)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityModel:
    """Encoder, gated attention and classifier; without `weights` it gives every document the same score."""

    constant: float
    weights: dict[str, np.ndarray] | None = None

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh((x - w["mean"]) / w["scale"] @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        raw = (v * u) @ w["a"]
        top = np.maximum.reduceat(raw, bags[:-1])
        weight = np.exp(raw - np.repeat(top, np.diff(bags)))
        weight /= np.repeat(np.add.reduceat(weight, bags[:-1]), np.diff(bags))
        z = np.add.reduceat(weight[:, None] * h, bags[:-1], axis=0)
        return {"h": h, "v": v, "u": u, "weight": weight, "z": z, "p": _sigmoid(z @ w["c"] + w["b"])}

    def scores(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bags) - 1, self.constant)
        return self.forward(x, bags)["p"].astype(np.float64)


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, hidden: int = 24, gate: int = 12, steps: int = 400) -> QualityModel:
    """Learns from bags of passages by full-batch Adam; both labels weigh the same in all. Repeatable."""
    good, bad = int(y.sum()), int(len(y) - y.sum())
    if not good or not bad:
        return QualityModel((good + 1) / (good + bad + 1))
    rng = np.random.default_rng(8)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    w = {
        "mean": x.mean(0), "scale": x.std(0) + np.float32(0.02), "E": draw(x.shape[1], hidden), "e": np.zeros(hidden, np.float32),
        "V": draw(hidden, gate), "U": draw(hidden, gate), "a": draw(gate), "c": draw(hidden), "b": np.zeros(1, np.float32),
    }
    model = QualityModel(0.0, w)
    learned = ["E", "e", "V", "U", "a", "c", "b"]
    first, second = ({k: np.zeros_like(w[k]) for k in learned} for _ in range(2))
    each = np.where(y == 1, 0.5 / good, 0.5 / bad).astype(np.float32)
    counts, scaled = np.diff(bags), (x - w["mean"]) / w["scale"]
    for step in range(1, steps + 1):
        f = model.forward(x, bags)
        d = each * (f["p"] - y)
        dz = d[:, None] * w["c"]
        dz_row = np.repeat(dz, counts, axis=0)
        slope = (dz_row * f["h"]).sum(1)
        mean = np.repeat(np.add.reduceat(f["weight"] * slope, bags[:-1]), counts)
        draw_ = f["weight"] * (slope - mean)  # of the attention's raw values
        dv = draw_[:, None] * w["a"] * f["u"] * (1 - f["v"] ** 2)
        du = draw_[:, None] * w["a"] * f["v"] * f["u"] * (1 - f["u"])
        dh = f["weight"][:, None] * dz_row + dv @ w["V"].T + du @ w["U"].T
        de = dh * (1 - f["h"] ** 2)
        found = {
            "E": scaled.T @ de, "e": de.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du, "a": (f["v"] * f["u"]).T @ draw_,
            "c": f["z"].T @ d, "b": np.array([d.sum()]),
        }
        for k in learned:
            g = found[k] + 1e-4 * w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] = (w[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def held_out() -> F.Column:
    """Whether a document's label is kept from learning: crc32 of the decimal doc_id leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = 4096, longest_bag: int = 64) -> QualityModel:
    """Learns `quality` from at most `sample` labelled documents, half of each label, that are not held out.

    Labels 0 and 1 count; of several labels of a document the least; null ids and labels don't. The sample goes by a hash of
    doc_id and takes documents of any length. Of one with more than `longest_bag` passages so many teach, spread evenly over the
    whole text, so the sample is bounded by parameters alone: sample x longest_bag x FEATURES floats reach the driver. With no
    labels of one kind the score is constant: (ones + 1) / (all + 1). doc_id may have any type that both tables share.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"))
    # Which labelled documents exist, by ids alone; then the few texts.
    able = docs.select("doc_id").distinct().join(known, "doc_id")
    kinds = [able.where(f"y = {k}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for k in (0, 1)]
    chosen = [(r["doc_id"], r["y"]) for r in kinds[0].union(kinds[1]).collect()]
    if not chosen:
        return QualityModel(1.0)
    kind = docs.schema["doc_id"].dataType.simpleString()
    picked = docs.sparkSession.createDataFrame(chosen, f"doc_id {kind}, y int")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def bags(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            every = (x[b:e] for _, x, bag in encode_passages(data, offsets) for b, e in zip(bag[:-1], bag[1:], strict=True))
            held = [x[np.linspace(0, len(x) - 1, min(len(x), longest_bag)).astype(np.int64)].tobytes() for x in every]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(held, pa.binary())], ["doc_id", "y", "x"])

    found = sorted(rows.mapInArrow(bags, f"doc_id {kind}, y int, x binary").collect())
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in found]
    return fit(np.concatenate(x), np.cumsum([0, *map(len, x)]), np.array([r["y"] for r in found], np.float32))


def with_quality(docs: DataFrame, model: QualityModel, name: str = "quality_score") -> DataFrame:
    """`docs` with the score (0 to 1) of each whole `text`; null and empty texts score as one empty passage.

    Every row is scored by its text alone; repeated rows get equal scores, and no other column is looked at.
    """
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        data, offsets = text_buffers(batch.column(at))
        found = [shared.value.scores(x, bags) for _, x, bags in encode_passages(data, offsets)]
        return [pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())]

    return with_columns(docs, f"{name} double", work)
