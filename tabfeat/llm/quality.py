"""Quality classifier: gated attention over the passages of a document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.llm.language_id import learnable, sampled_by_label, within_bytes
from tabfeat.session import small_side

PASSAGE_WORDS = 64
PAIRS = 508
FEATURES, HIDDEN, ATTENTION = PAIRS + 4, 32, 16
SAMPLE_PER_LABEL = 1_500  # bound on the labelled documents that the classifier learns from
EPOCHS, BATCH, RATE = 12, 64, 0.01
_PAIR = ((B.mixed(np.arange(1, 65537, dtype=np.uint64)) >> np.uint64(32)) % np.uint64(PAIRS)).astype(np.int64)


def passage_features(part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What every passage looks like, and each document's first passage.

    Root shares of hashed byte pairs, of words that repeat the word before or the one before that, of
    capital letters, and of words among the bytes. A passage is 64 consecutive words with what stands behind them; a document without words has one
    passage of zeros.
    """
    rows = len(at) - 1
    padded, starts, stops, first = B.words(part, at, B.SPACED)
    counts = np.diff(first)
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    cuts = np.concatenate([[0], np.cumsum(passages)])
    nth = np.arange(cuts[-1]) - np.repeat(cuts[:-1], passages)
    begin = np.repeat(at[:-1] + np.arange(rows), passages)
    later = np.flatnonzero(nth > 0)
    begin[later] = starts[np.repeat(first[:-1], passages)[later] + nth[later] * PASSAGE_WORDS]
    ends = np.append(begin, len(padded))
    sizes = np.diff(ends)
    pairs = _PAIR[padded[:-1].astype(np.int64) << 8 | padded[1:]] if len(padded) > 1 else np.zeros(0, np.int64)
    passage = np.repeat(np.arange(len(begin)), sizes)[:len(pairs)]
    seen = np.bincount(passage * PAIRS + pairs, minlength=len(begin) * PAIRS).reshape(-1, PAIRS)
    word = B.range_hashes(padded, starts, stops)
    cut = np.searchsorted(starts, ends)
    words = np.maximum(1, np.diff(cut))

    def among_words(marks):
        return np.diff(np.concatenate([[0], np.cumsum(marks)])[cut]) / words

    again = [np.concatenate([np.zeros(min(k, len(word)), bool), word[k:] == word[:-k]]) for k in (1, 2)]
    capital = np.diff(np.concatenate([[0], np.cumsum((padded >= 0x41) & (padded <= 0x5A))])[ends]) / np.maximum(1, sizes)
    shares = np.column_stack([seen / np.maximum(1, sizes)[:, None], *map(among_words, again), capital, words / np.maximum(1, sizes)])
    return np.sqrt(shares).astype(np.float32), cuts


def _forward(net: dict, x: np.ndarray, cuts: np.ndarray) -> dict:
    """Passage codes, gated attention within each document, and the logit of the weighted code."""
    h = np.tanh(x @ net["code"] + net["code_bias"])
    t, g = np.tanh(h @ net["tanh"]), 1 / (1 + np.exp(-(h @ net["gate"])))
    e = (t * g) @ net["weigh"]
    row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    w = np.exp(e - np.maximum.reduceat(e, cuts[:-1])[row])
    w /= np.add.reduceat(w, cuts[:-1])[row]
    z = np.add.reduceat(w[:, None] * h, cuts[:-1], axis=0)
    return {"h": h, "t": t, "g": g, "w": w, "z": z, "row": row, "p": 1 / (1 + np.exp(-(z @ net["out"] + net["out_bias"])))}


def _gradient(net: dict, x: np.ndarray, cuts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(net, x, cuts)
    d = ((f["p"] - label) * weight / weight.sum()).astype(np.float32)
    dz = d[:, None] * net["out"]
    dz_row = dz[f["row"]]
    dw = (dz_row * f["h"]).sum(axis=1)
    de = f["w"] * (dw - np.add.reduceat(f["w"] * dw, cuts[:-1])[f["row"]])
    dtg = de[:, None] * net["weigh"]
    dt, dg = dtg * f["g"] * (1 - f["t"]**2), dtg * f["t"] * f["g"] * (1 - f["g"])
    dh = (f["w"][:, None] * dz_row + dt @ net["tanh"].T + dg @ net["gate"].T) * (1 - f["h"]**2)
    return {"out": f["z"].T @ d, "out_bias": d.sum(), "weigh": (f["t"] * f["g"]).T @ de, "tanh": f["h"].T @ dt,
            "gate": f["h"].T @ dg, "code": x.T @ dh, "code_bias": dh.sum(axis=0)}


def train(x: np.ndarray, cuts: np.ndarray, label: np.ndarray, weight: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {"code": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "code_bias": np.zeros(HIDDEN), "tanh": rng.normal(0, 0.2, (HIDDEN, ATTENTION)),
           "gate": rng.normal(0, 0.2, (HIDDEN, ATTENTION)), "weigh": rng.normal(0, 0.2, ATTENTION),
           "out": rng.normal(0, 0.2, HIDDEN), "out_bias": np.zeros(())}
    net = {k: v.astype(np.float32) for k, v in net.items()}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    step, steps = 0, EPOCHS * -(-len(label) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for at in range(0, len(order), BATCH):
            step += 1
            rows = order[at:at + BATCH]
            sizes = cuts[rows + 1] - cuts[rows]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            own = np.repeat(cuts[rows] - ends[:-1], sizes) + np.arange(ends[-1])
            for k, g in _gradient(net, x[own], ends, label[rows], weight[rows]).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net[k] = net[k] - (RATE * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def _features_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = B.flatten(pa.array(texts, pa.string()))
    xs, sizes = [], []
    for _, _, part, at in B.slices(data, offsets):
        x, cuts = passage_features(part, at)
        xs.append(x)
        sizes.append(np.diff(cuts))
    return np.concatenate(xs), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def score_quality(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """Score every whole text: how likely its quality label is 1.

    Every passage is encoded; gated attention, learnt from document labels only, weighs the passages, and
    the weighted code is scored. It learns from a bounded sample: about ``per_label`` documents of each
    label, of at most ``SAMPLE_BYTES`` in all, whose crc32(doc_id as text) mod 3 is not 1, weighted back to
    the labels' shares; one text of each doc_id, that with the least hash.

    One row per input row: doc_id, held_out (that remainder is 1, or the doc_id is null), score,
    predicted (1 if score >= 0.5). Null texts are scored as empty; a doc_id with several labels counts
    with each; without labels of both kinds the score is the share of label 1, or 0.5. Other columns
    are ignored.
    """
    B.bounded_batches(docs.sparkSession)
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen, counts = sampled_by_label(known.where(learnable(3, 1)), "quality", per_label)
    # Bounded by per_label and counted, so the texts need not be shuffled to find the sample's.
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(small_side(chosen), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    rows = sorted((r["doc_id"], r["quality"], r["text"]) for r in within_bytes(rows, "quality").collect())
    label = np.array([r[1] for r in rows], np.float32)
    fixed = 0.5 if not counts else counts.get(1, 0) / sum(counts.values())
    net = None
    if len(set(label.tolist())) == 2:
        weight = np.where(label == 1, counts[1] / label.sum(), counts[0] / (1 - label).sum()).astype(np.float32)
        net = train(*_features_of([r[2] for r in rows]), label, weight / weight.mean())
    shipped = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        net = shipped.value
        for batch in batches:
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                p = np.full(stop - start, fixed)
                if net is not None:
                    p = _forward(net, *passage_features(part, at))["p"].astype(np.float64)
                rows = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", (~learnable(3, 1)).alias("held_out")).mapInArrow(
        score, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
