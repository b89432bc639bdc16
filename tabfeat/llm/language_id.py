"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B

UNKNOWN = "und"
SAMPLE_PER_LANGUAGE = 300  # bound on the labelled documents that the network learns from
HIDDEN = 16
LONGEST = 24  # a longer word is read in pieces of so many bytes
STEPS, BATCH, RATE = 500, 256, 0.02
_REMEMBERED = 300_000
_REMEMBERED_BYTES = 64 << 20
SAMPLE_BYTES = 32 << 20  # bound on the texts of each label that are learnt from
_LETTER = regex.compile(r"\p{L}")


# --- the network --------------------------------------------------------------------------

def _new_network(languages: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = {"out": rng.normal(0, 0.1, (2 * HIDDEN, languages)), "bias": np.zeros(languages)}
    for way in "fb":
        net |= {f"{way}_in": rng.normal(0, 0.3, (256, 3 * HIDDEN)), f"{way}_state": rng.normal(0, 0.25, (HIDDEN, 3 * HIDDEN)),
                f"{way}_bias": np.zeros(3 * HIDDEN)}
    return {k: v.astype(np.float32) for k, v in net.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _read(net: dict, way: str, x: np.ndarray, steps: list | None = None) -> np.ndarray:
    """States of one direction after each byte; ``x`` holds words of equal length, one per row."""
    h = np.zeros((len(x), HIDDEN), np.float32)
    states = np.empty((x.shape[1], len(x), HIDDEN), np.float32)
    order = range(x.shape[1]) if way == "f" else reversed(range(x.shape[1]))
    for t in order:
        a = net[f"{way}_in"][x[:, t]] + net[f"{way}_bias"]
        u = h @ net[f"{way}_state"]
        gates = _sigmoid(a[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(a[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
        if steps is not None:
            steps.append((t, h, z, r, n, u[:, 2 * HIDDEN:]))
        h = n + z * (h - n)
        states[t] = h
    return states


def label_positions(net: dict, x: np.ndarray) -> np.ndarray:
    """Language probabilities at every byte: (bytes, words, languages)."""
    states = np.concatenate([_read(net, "f", x), _read(net, "b", x)], axis=2)
    scores = states @ net["out"] + net["bias"]
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    return scores / scores.sum(axis=2, keepdims=True)


def _gradient(net: dict, x: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy over all positions, by backpropagation through time in both directions."""
    steps = {"f": [], "b": []}
    states = np.concatenate([_read(net, way, x, steps[way]) for way in "fb"], axis=2)
    scores = states @ net["out"] + net["bias"]
    p = np.exp(scores - scores.max(axis=2, keepdims=True))
    p /= p.sum(axis=2, keepdims=True)
    p[:, np.arange(len(label)), label] -= 1
    p /= p.shape[0] * p.shape[1]
    flat = states.reshape(-1, 2 * HIDDEN)
    grad = {"out": flat.T @ p.reshape(-1, p.shape[2]), "bias": p.sum(axis=(0, 1))}
    back = p @ net["out"].T
    for k, way in enumerate("fb"):
        own = back[:, :, k * HIDDEN:(k + 1) * HIDDEN]
        d_in, d_state = np.zeros_like(net[f"{way}_in"]), np.zeros_like(net[f"{way}_state"])
        d_bias, dh = np.zeros(3 * HIDDEN, np.float32), np.zeros((len(x), HIDDEN), np.float32)
        for t, h, z, r, n, u in reversed(steps[way]):
            dh = dh + own[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz, dr = dh * (h - n) * z * (1 - z), dn * u * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(d_in, x[:, t], da)
            d_bias += da.sum(axis=0)
            d_state += h.T @ du
            dh = dh * z + du @ net[f"{way}_state"].T
        grad |= {f"{way}_in": d_in, f"{way}_state": d_state, f"{way}_bias": d_bias}
    return grad


def train(texts: list[str], labels: list[int], languages: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network to the words of labelled texts, in batches of words of one length."""
    counts: dict[tuple[bytes, int], int] = {}
    for text, label in zip(texts, labels):
        for word in text.encode().split():
            for at in range(0, len(word), LONGEST):
                key = (word[at:at + LONGEST], label)
                counts[key] = counts.get(key, 0) + 1
    net, rng = _new_network(languages, seed), np.random.default_rng(seed)
    if not counts:
        return net
    share = np.zeros(languages)
    for (word, label), n in counts.items():
        share[label] += np.sqrt(n)
    groups: dict[int, list] = {}
    for (word, label), n in sorted(counts.items()):
        groups.setdefault(len(word), []).append((word, label, np.sqrt(n) / share[label]))
    lengths = sorted(groups)
    tables = {}
    for size in lengths:
        words, label, weight = zip(*groups[size])
        x = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
        weight = np.array(weight)
        tables[size] = (x, np.array(label), np.cumsum(weight) / weight.sum(), weight.sum())
    often = np.array([tables[s][3] for s in lengths])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    for step in range(1, STEPS + 1):
        x, label, edges, _ = tables[lengths[rng.choice(len(lengths), p=often / often.sum())]]
        pick = np.minimum(np.searchsorted(edges, rng.random(BATCH)), len(x) - 1)
        rate = RATE * (1 - step / (STEPS + 1))
        for k, g in _gradient(net, x[pick], label[pick]).items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            net[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


# --- documents ----------------------------------------------------------------------------

class _Words(dict):
    """Numbers words; the network reads each distinct one once."""

    def __init__(self, net: dict):
        super().__init__()
        self.net, self.sums, self.bytes = net, np.zeros((0, len(net["bias"]) + 1)), 0

    def __missing__(self, word):
        self[word] = number = len(self)
        self.bytes += len(word)
        return number

    def label_new(self) -> None:
        """Add up the position labels of words that came since; the last column counts positions."""
        new = list(islice(self, len(self.sums), None))
        if not new:
            return
        sums = np.zeros((len(new), self.sums.shape[1]))
        pieces = [(len(w[at:at + LONGEST]), i, w[at:at + LONGEST]) for i, w in enumerate(new) for at in range(0, len(w), LONGEST)]
        by_size: dict[int, list] = {}
        for size, i, piece in pieces:
            by_size.setdefault(size, []).append((i, piece))
        for size, found in by_size.items():
            for at in range(0, len(found), 4096):
                rows, words = zip(*found[at:at + 4096])
                p = label_positions(self.net, np.frombuffer(b"".join(words), np.uint8).reshape(-1, size))
                np.add.at(sums, np.array(rows), np.column_stack([p.sum(axis=0), np.full(len(rows), size)]))
        self.sums = np.concatenate([self.sums, sums])


def learnable(fold: int = 4, left_out: int = 2) -> Column:
    """Rows that may be learnt from: crc32 of the doc_id as text leaves another remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold != left_out, F.lit(False))


def sampled_by_label(rows: DataFrame, label: str, per_label: int, by: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, dict]:
    """About ``per_label`` rows of each label, chosen by a hash of ``by``, and the rows of each label. Equal rows count once."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    scale = 1 << 60  # fine enough for a share of any number of rows
    limit = F.lit(0).cast("bigint")
    for value, n in counts.items():
        limit = F.when(F.col(label) == F.lit(value), F.lit(int(scale * min(1, per_label / n)))).otherwise(limit)
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(scale)) < limit).distinct(), counts


def within_bytes(rows: DataFrame, label: str, most: int = SAMPLE_BYTES) -> DataFrame:
    """Of a sample's texts so many for each label, in order of a hash, that they stay within ``most`` bytes. A row counts 100 more."""
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text")
    return (rows.withColumn("held", F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 100).over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("held") <= most).drop("held"))


def _predictor(docs: DataFrame, per_language: int):
    """A function from texts to languages and scores, learnt from a sample of labelled rows, and whether there were any."""
    B.bounded_batches(docs.sparkSession)
    rows, counts = sampled_by_label(
        docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & learnable()).select("doc_id", "text", "lang"), "lang", per_language, ("doc_id", "text"))
    languages = sorted(counts)
    sample = sorted((r["doc_id"], r["lang"], r["text"]) for r in within_bytes(rows, "lang").collect())
    net = train([r[2] for r in sample], [languages.index(r[1]) for r in sample], len(languages)) if languages else None
    shipped = docs.sparkSession.sparkContext.broadcast(net)

    def predictor():
        words = _Words(shipped.value) if languages else None

        def predict(texts: list) -> tuple[list[str], np.ndarray]:
            nonlocal words
            named, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if languages and t and _LETTER.search(t)]
            if some:
                if len(words) > _REMEMBERED or words.bytes > _REMEMBERED_BYTES:
                    words = _Words(shipped.value)
                found = [[*map(words.__getitem__, texts[i].encode().split())] for i in some]
                words.label_new()
                for i, numbers in zip(some, found):
                    total = words.sums[numbers].sum(axis=0)
                    best = int(total[:-1].argmax())
                    named[i], scores[i] = languages[best], min(1.0, total[best] / total[-1])
            return named, scores
        return predict

    return predictor, bool(languages)


def _text_slices(batches):
    for batch in batches:
        for start, stop, _, _ in B.slices(*B.flatten(batch.column("text"))):
            yield batch.slice(start, stop - start)


def identify_language(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Predict the language of every whole text with a network learnt from labelled rows.

    The network labels every byte from the gated states of both reading directions; it starts afresh at
    ASCII white space, so equal words are read once per task. A document's probabilities are the means
    over its bytes. It learns from a bounded sample: about ``per_language`` documents, of at most
    ``SAMPLE_BYTES`` in all, of each non-null lang whose crc32(doc_id as text) mod 4 is not 2.

    One row per input row: doc_id, held_out (that remainder is 2, or the doc_id is null), lang_pred,
    score. A text that is null or has no letter is ``und`` with score 0, and so is every text if there
    is nothing to learn from. Other columns are ignored.
    """
    predictor, _ = _predictor(docs, per_language)

    def predict(batches):
        of = predictor()
        for rows in _text_slices(batches):
            named, scores = of(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(named, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "text", (~learnable()).alias("held_out")).mapInArrow(
        predict, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not those that are null or have no letter. All columns stay.

    If there is nothing to learn from, every text with a letter stays.
    """
    predictor, learnt = _predictor(docs, per_language)

    def keep(batches):
        of = predictor()
        for rows in _text_slices(batches):
            texts = rows.column("text").to_pylist()
            # A learnt language may be called ``und`` too; only a text without letters scores 0.
            kept = (of(texts)[1] > 0).tolist() if learnt else [bool(t and _LETTER.search(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(rows.filter(pa.array(kept, pa.bool_())).columns, docs_columns)

    # Other names may hold dots, which mapInArrow would take for fields.
    docs_columns = docs.columns
    plain = docs.toDF(*[c if c == "text" else f"c{i}" for i, c in enumerate(docs_columns)])
    return plain.mapInArrow(keep, docs.schema)
