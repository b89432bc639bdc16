"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.session import checkpointed

FOLD, LEFT_OUT = 7, 2
CLASSES, MEMBERS = 16, 32
SYMBOLS = CLASSES * MEMBERS
TAILS = 128  # symbols of all words beyond the frequent ones, told apart by their last two bytes
HEADS = SYMBOLS - TAILS - 1  # frequent words with a symbol of their own; symbol HEADS ends a text
END, START = HEADS, SYMBOLS
PAIR_ROWS = 1 << 15
BRANCH, BRANCH_BITS, CODE_BITS = 16, 4, 20  # a word of a tail is told by digits of its code, as many as the words need
LEAF_WORDS = 4  # words of a tail that share all digits, about
MOST_ROWS = 1 << 16  # of a digit's table; their numbers fit sixteen bits
COUNTING = 8  # tasks that add up the digits of all words
CHUNK = 4096  # tokens to a gradient step
ROUNDS, RATE = 2, 0.15
TASK_BYTES = 64 << 20
WORDS_HELD = 1 << 20  # distinct words whose counts a task holds before it passes them on
_SYMBOL, _UNSEEN, _CODE = np.uint32(SYMBOLS - 1), np.uint32(SYMBOLS), np.uint32(10)  # a token's symbol, mark and code in 32 bits
_END_HASH = np.uint64(0x5851F42D4C957F2D)
_FIRST = np.uint64(1 << 63)


def _learnt(ids: np.ndarray) -> np.ndarray:
    return np.array([i != B.NO_ID and zlib.crc32(str(i).encode()) % FOLD != LEFT_OUT for i in ids.tolist()], bool)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    return B.powers(2 * B.SLICE_BYTES)


def _tokens(part: np.ndarray, at: np.ndarray):
    """Token hashes of a slice, each text's end included, the words' last two bytes, and cuts per document."""
    lower = part.copy()
    capital = (lower >= 0x41) & (lower <= 0x5A)
    lower[capital] += 0x20
    padded, starts, stops, first = B.words(lower, at, B.SPACED)
    word = B.range_hashes(padded, starts, stops, _powers() if len(padded) < 2 * B.SLICE_BYTES else None)
    rows = len(at) - 1
    cuts = first + np.arange(rows + 1)
    hashes = np.empty(len(word) + rows, np.uint64)
    tails = np.zeros(len(hashes), np.int64)
    is_end = np.zeros(len(hashes), bool)
    is_end[cuts[1:] - 1] = True
    hashes[is_end], hashes[~is_end] = _END_HASH, word
    two = padded[stops - 1].astype(np.uint64) << np.uint64(8) | padded[np.maximum(stops - 2, starts)]
    tails[~is_end] = HEADS + 1 + (B.mixed(two + np.uint64(1)) % np.uint64(TAILS)).astype(np.int64)
    return hashes, tails, is_end, cuts


def _batch_tokens(table: pa.Table):
    table = table.sort_by("id")
    ids, (data, offsets) = table["id"].to_numpy(), B.flatten(table["text"])
    learnt = _learnt(ids)
    for start, stop, part, at in B.slices(data, offsets):
        yield ids[start:stop], learnt[start:stop], *_tokens(part, at)


def _codes(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - CODE_BITS)


def _keys(hashes: np.ndarray, tails: np.ndarray, levels: int) -> np.ndarray:
    """Words as keys whose upper half is that of their leaf, so that the words of a leaf meet in one bucket."""
    leaf = (tails.astype(np.uint64) << np.uint64(CODE_BITS)) | (_codes(hashes) >> np.uint64(CODE_BITS - BRANCH_BITS * levels))
    return (B.mixed(leaf + np.uint64(1)) >> np.uint64(32) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _count_keys(table: pa.Table, levels: int) -> np.ndarray:
    """Distinct words of the batch and how often they occur in texts to learn from."""
    keys, counts = [], []
    for _, learnt, hashes, tails, _, cuts in _batch_tokens(table):
        weight = np.repeat(learnt, np.diff(cuts))
        key, inverse = np.unique(_keys(hashes, tails, levels), return_inverse=True)
        keys.append(key)
        counts.append(np.bincount(inverse, weights=weight, minlength=len(key)))
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(key)).astype(np.uint64)
    return np.column_stack([key, total]).ravel()


def _total_counts(keys: np.ndarray, counts: np.ndarray, heads: np.ndarray) -> list[np.ndarray]:
    """The count over all batches, marked in the first batch that has the word, and that of its leaf without heads."""
    word, first, inverse = np.unique(keys[::2], return_index=True, return_inverse=True)
    total = np.bincount(inverse, weights=keys[1::2], minlength=len(word))
    leaf = np.unique(word >> np.uint64(32), return_inverse=True)[1]
    of_leaf = np.bincount(leaf, weights=np.where(B.among(word, heads), 0, total), minlength=len(word))[leaf]
    found = np.column_stack([total, of_leaf]).astype(np.uint64)[inverse]
    found[first, 0] |= _FIRST
    return B.split_like(found.ravel(), 2 * counts)


def _word_counts(batches):
    """How often every word occurs in this task's texts to learn from, and its tail; a word may have several rows."""
    held = []
    for batch in batches:
        learnt = batch.column("learnt").to_numpy(zero_copy_only=False)
        for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
            hashes, tails, is_end, cuts = _tokens(part, at)
            own = np.repeat(learnt[start:stop], np.diff(cuts)) & ~is_end
            key, first, n = np.unique(hashes[own], return_index=True, return_counts=True)
            held.append((key, tails[own][first], n))
            if sum(len(h[0]) for h in held) > WORDS_HELD:
                held = [_added(held)]
                if len(held[0][0]) > WORDS_HELD // 2:
                    yield _count_rows(*held[0])
                    held = []
    if held:
        yield _count_rows(*_added(held))


def _added(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, tails, counts = (np.concatenate(c) for c in zip(*held, strict=True))
    key, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return key, tails[first], np.bincount(inverse, weights=counts, minlength=len(key)).astype(np.int64)


def _count_rows(key: np.ndarray, tail: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(tail.astype(np.int32)), pa.array(n)], ["key", "tail", "n"])


def _sizes(words: int) -> tuple[int, int]:
    """Digits to a word's code, and rows to a digit's table: both grow with the number of words counted."""
    levels = 1
    while levels * BRANCH_BITS < CODE_BITS and TAILS * BRANCH**levels * LEAF_WORDS < words:
        levels += 1
    rows = 1 << 14
    while rows < MOST_ROWS and rows * 16 < words:
        rows *= 2
    return levels, rows


def _node_counts(words: DataFrame, heads: np.ndarray, levels: int, rows: int) -> np.ndarray:
    """How many tokens take each branch, by digit and row of its table's nodes."""
    shape = (levels, rows // 4, BRANCH)

    def count(batches):
        total = np.zeros(shape)
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            tail = ~B.among(key, heads)
            symbols, codes = batch.column("tail").to_numpy()[tail].astype(np.uint64), _codes(key[tail])
            for level in range(levels):
                node, digit = _nodes(symbols, codes, level)
                slot = (B.mixed(node) % np.uint64(rows // 4)).astype(np.int64) * BRANCH + digit
                total[level] += np.bincount(slot, weights=batch.column("n").to_numpy()[tail], minlength=shape[1] * BRANCH).reshape(shape[1:])
        flat = total.ravel()
        for at in range(0, len(flat), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([flat[at:at + (1 << 16)].tobytes()], pa.binary())], ["at", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(n) for n in table["n"].to_pylist()], axis=0)
        return pa.table({"at": table["at"][:1], "n": pa.array([total.tobytes()], pa.binary())})

    found = words.coalesce(COUNTING).mapInArrow(count, "at int, n binary").groupBy("at").applyInArrow(add, "at int, n binary").collect()
    return np.concatenate([np.frombuffer(n) for _, n in sorted(found)]).reshape(shape) if found else np.zeros(shape)


# --- the model ----------------------------------------------------------------------------

def _contexts(symbols: np.ndarray, codes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows, one line per feature: bias, the word before, two skips, and the hashed pair before; and the word before itself.

    Skips know a word by its symbol, the pair by symbol and code, which tell it from all others but few.
    """
    place = np.arange(len(symbols)) - np.repeat(cuts[:-1], np.diff(cuts))
    before, words, own = [], [], symbols | codes << 10
    for k in (1, 2, 3):
        s = np.concatenate([np.full(min(k, len(symbols)), START), symbols[:-k]])
        s[place < k] = START
        before.append(s)
        if k < 3:
            w = np.concatenate([np.full(min(k, len(symbols)), START), own[:-k]])
            w[place < k] = START
            words.append(w.astype(np.uint64))
    a, b, c = before
    pair = (B.mixed((words[0] << np.uint64(32)) + words[1] + np.uint64(1)) % np.uint64(PAIR_ROWS)).astype(np.int64)
    width = SYMBOLS + 1
    # All row numbers fit sixteen bits, which sort and copy fast.
    return np.array([np.zeros(len(a), np.int64), 1 + a, 1 + width + b, 1 + 2 * width + c, 1 + 3 * width + pair], np.uint16), words[0]


_SINGLE_ROWS = 1 + 3 * (SYMBOLS + 1)
_CLASS_ROWS = _SINGLE_ROWS + PAIR_ROWS
_MEMBER_ROWS = 1 << 16
_MEMBER_PAIRS = _MEMBER_ROWS - _SINGLE_ROWS * CLASSES


def _nodes(symbols: np.ndarray, codes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The node that a word's first digits lead to, as a number of its own, and the digit that follows."""
    upto = codes >> np.uint64(CODE_BITS - BRANCH_BITS * level)
    node = (((symbols << np.uint64(CODE_BITS)) | upto) << np.uint64(3)) | np.uint64(level + 1)
    return node, ((codes >> np.uint64(CODE_BITS - BRANCH_BITS * (level + 1))) & np.uint64(BRANCH - 1)).astype(np.int64)


def _digits(symbols: np.ndarray, codes: np.ndarray, before: np.ndarray, levels: int, rows: int):
    """Per digit of words of tails: feature rows (the node, the node after the word before) and the digit."""
    symbols, codes, nodes = symbols.astype(np.uint64), codes.astype(np.uint64), np.uint64(rows // 4)
    after = before << np.uint64(33)
    for level in range(levels):
        node, digit = _nodes(symbols, codes, level)
        yield level, np.array([B.mixed(node) % nodes, nodes + B.mixed(node ^ after) % np.uint64(rows - rows // 4)], np.uint16), digit


def _levels(model: dict) -> int:
    return len(model) - 2


def new_model(counts: np.ndarray, branches: np.ndarray) -> dict[str, np.ndarray]:
    """No context yet: class and member shares of the symbols, and shares of the branches to the words of tails."""
    share = np.log((counts + 0.5).reshape(CLASSES, MEMBERS))
    model = {"class": np.zeros((_CLASS_ROWS, CLASSES), np.float32), "member": np.zeros((_MEMBER_ROWS, MEMBERS), np.float32)}
    model["class"][0] = np.log((counts + 0.5).reshape(CLASSES, MEMBERS).sum(axis=1))
    model["member"][:CLASSES] = share
    for k in ("class", "member"):
        own = model[k][:1] if k == "class" else model[k][:CLASSES]
        own -= own.max(axis=1, keepdims=True)
    for level, taken in enumerate(branches):
        weights = model[f"digit{level}"] = np.zeros((4 * len(taken), BRANCH), np.float32)
        share = np.log(taken + 0.5)
        weights[:len(taken)] = share - share.max(axis=1, keepdims=True)
    return model


def _exponentials(weights: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every token's unnormalised probabilities, and their sum."""
    scores = weights.take(rows[0], axis=0)
    more = np.empty_like(scores)
    for own in rows[1:]:
        scores += weights.take(own, axis=0, out=more, mode="clip")
    top = scores.max(initial=0)
    # One shift does for all tokens where none of their scores would vanish.
    scores -= top if top - scores.min(initial=0) < 80 else scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    return scores, scores @ np.ones(scores.shape[1], np.float32)


def _member_rows(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    found = rows * np.uint16(CLASSES) + classes.astype(np.uint16)
    pair = rows[4].astype(np.uint32) * np.uint32(CLASSES) + classes.astype(np.uint32)
    found[4] = _SINGLE_ROWS * CLASSES + (pair * np.uint32(2654435761) >> np.uint32(8)) % np.uint32(_MEMBER_PAIRS)
    return found


def log_probabilities(model: dict, symbols: np.ndarray, codes: np.ndarray, unseen: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """log10 of every token's probability: its class given the context, the symbol within it, and a tail's seen word by its digits."""
    (rows, before), classes, members = _contexts(symbols, codes, cuts), symbols // MEMBERS, symbols % MEMBERS
    member_rows, logs = _member_rows(rows, classes), np.zeros(len(symbols), np.float32)
    words = np.flatnonzero((symbols > END) & ~unseen)
    for at in range(0, len(words) if _levels(model) else 0, CHUNK):
        own = words[at:at + CHUNK]
        for level, features, digit in _digits(symbols[own], codes[own], before[own], _levels(model), len(model["digit0"])):
            scores, total = _exponentials(model[f"digit{level}"], features)
            logs[own] += np.log10(scores[np.arange(len(total)), digit] / total)
    for at in range(0, len(symbols), CHUNK):
        own = slice(at, at + CHUNK)
        for weights, features, target in ((model["class"], rows, classes), (model["member"], member_rows, members)):
            scores, total = _exponentials(weights, features[:, own])
            logs[own] += np.log10(scores[np.arange(len(total)), target[own]] / total)
    return logs


def _step(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One gradient step with a step size per weight, on the touched rows only."""
    d, total = _exponentials(weights, rows)
    d /= total[:, None]
    d[np.arange(len(target)), target] -= 1
    in_order = np.empty_like(d)
    for own in rows:
        if (own == own[0]).all():
            at, g = own[:1], d.sum(axis=0, keepdims=True)
        else:
            order = own.argsort(kind="stable")
            row = own.take(order)
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            at = row.take(starts)
            d.take(order, axis=0, out=in_order, mode="clip")
            g = _run_sums(in_order, starts)
        step = squares.take(at, axis=0)
        step += g * g
        _put(squares, at, step)
        step += 1
        np.divide(g, np.sqrt(step, out=step), out=step)
        step *= np.float32(RATE)
        _put(weights, at, np.subtract(weights.take(at, axis=0), step, out=step))


def _run_sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows from each start to the next."""
    if 2 * len(starts) < len(x):
        # Seen as complex numbers, two sums are added up at a time.
        return np.add.reduceat(x.view(np.complex64), starts, axis=0).view(np.float32)
    # Most runs are of one row, or of two.
    size, found = np.diff(starts, append=len(x)), x.take(starts, axis=0)
    two, many = np.flatnonzero(size == 2), np.flatnonzero(size > 2)
    found[two] += x.take(starts[two] + 1, axis=0)
    if len(many):
        own = size[many]
        cuts = np.cumsum(own) - own
        rows = x.take(np.repeat(starts[many] - cuts, own) + np.arange(own.sum()), axis=0)
        found[many] = np.add.reduceat(rows.view(np.complex64), cuts, axis=0).view(np.float32)
    return found


def _put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``table[at] = rows``, copying whole rows."""
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(whole)[at, 0] = rows.view(whole)[:, 0]


def learn(model: dict, parts) -> tuple[dict[str, np.ndarray], int]:
    """Gradient steps over (symbols, codes, cuts) parts, and the number of tokens."""
    model = {k: v.copy() for k, v in model.items()}
    squares = {k: np.zeros_like(v) for k, v in model.items()}
    total = 0
    for symbols, codes, cuts in parts:
        (rows, before), classes = _contexts(symbols, codes, cuts), symbols // MEMBERS
        member_rows, words = _member_rows(rows, classes), np.flatnonzero(symbols > END)
        for at in range(0, len(symbols), CHUNK):
            own = slice(at, at + CHUNK)
            _step(model["class"], squares["class"], rows[:, own], classes[own])
            _step(model["member"], squares["member"], member_rows[:, own], symbols[own] % MEMBERS)
        for at in range(0, len(words) if _levels(model) else 0, CHUNK):
            own = words[at:at + CHUNK]
            for level, features, digit in _digits(symbols[own], codes[own], before[own], _levels(model), len(model["digit0"])):
                _step(model[f"digit{level}"], squares[f"digit{level}"], features, digit)
        total += len(symbols)
    return model, total


def _parts(batches, learnt_only: bool):
    """Symbols and cuts of the encoded rows, about 256,000 tokens at a time."""
    for batch in batches:
        if learnt_only:
            batch = batch.filter(pa.compute.invert(batch.column("held_out")))
        sizes = batch.column("n_tokens").to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + 256_000, side="right")) - 1)
            rows = batch.slice(start, stop - start)
            marked = np.frombuffer(b"".join(rows.column("symbols").to_pylist()), np.uint32)
            yield (rows, (marked & _SYMBOL).astype(np.int64), (marked >> _CODE).astype(np.int64), marked & _UNSEEN > 0,
                   ends[start:stop + 1] - ends[start])
            start = stop


def _mixed_models(encoded: DataFrame, model: dict, tasks: int) -> dict[str, np.ndarray]:
    """Every task takes gradient steps over its share of the texts; the steps are averaged by tokens."""
    shipped = encoded.sparkSession.sparkContext.broadcast(model)

    def descend(batches):
        learnt, n = learn(shipped.value, ((s, w, c) for _, s, w, _, c in _parts(batches, True)))
        if n:
            for k, v in learnt.items():
                for at in range(0, len(v), 2048):
                    # Half precision does for a step: the model itself keeps its digits.
                    step = (v[at:at + 2048] - shipped.value[k][at:at + 2048]).astype(np.float16)
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([at], pa.int32()), pa.array([n], pa.int64()),
                                                      pa.array([step.tobytes()], pa.binary())], ["name", "at", "n", "step"])

    def average(table: pa.Table) -> pa.Table:
        steps = [np.frombuffer(s, np.float16).astype(np.float32) for s in table["step"].to_pylist()]
        mean = np.average(steps, axis=0, weights=table["n"].to_numpy()).astype(np.float32)
        return pa.table({"name": table["name"][:1], "at": table["at"][:1], "step": pa.array([mean.tobytes()], pa.binary())})

    found = (encoded.select("held_out", "n_tokens", "symbols").coalesce(tasks)
             .mapInArrow(descend, "name string, at int, n bigint, step binary")
             .groupBy("name", "at").applyInArrow(average, "name string, at int, step binary").collect())
    model = {k: v.copy() for k, v in model.items()}
    for name, at, step in found:
        width = model[name].shape[1]
        model[name][at:at + 2048] += np.frombuffer(step, np.float32).reshape(-1, width)
    shipped.unpersist()
    return model


# --- documents ----------------------------------------------------------------------------

_ENCODED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_own bigint, log_counts double, "
            "log_tail double, owned array<bigint>, symbols binary")


def score_texts(docs: DataFrame) -> DataFrame:
    """log10 probability of every whole text, under a unigram base and under the model.

    Tokens are runs without ASCII white space, A-Z lower-cased, and one end per text. Words are counted
    over all texts whose crc32(doc_id as text) mod 7 is not 2. The most frequent words, by these counts of
    every word, are symbols, the others share tail symbols by their last two bytes. A token's probability is that of its symbol's class, of
    the symbol in its class (both softmaxes over hashed features of the three tokens before), and, for a
    tail symbol, of the word in it. A seen word is found by the digits of its hash, each of them a softmax
    over hashed features of the digits and the word before; there are as many digits as tell all counted words
    apart but for about four, which share by their counts. An unseen word has the share of words seen
    once, spread over as many words as were seen.

    One row per input row: doc_id, held_out (that remainder is 2, or the doc_id is null), n_tokens,
    n_known, train_tokens, base_score, score. A null text is empty, its only token the end. Without
    anything to learn from, the base is 0 and symbols are equally likely. Other columns are ignored.
    """
    B.bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    learnt = F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string")) % FOLD != LEFT_OUT, F.lit(False))
    words = (docs.select("text", learnt.alias("learnt")).mapInArrow(_word_counts, "key bigint, tail int, n bigint")
             .groupBy("key").agg(F.min("tail").alias("tail"), F.sum("n").alias("n")).persist(StorageLevel.MEMORY_AND_DISK))
    levels, table_rows = _sizes(words.count())
    top = words.orderBy(F.desc("n"), "key").limit(HEADS).collect()
    heads = np.array([r[0] for r in top], np.int64).view(np.uint64)
    branches = _node_counts(words, np.sort(heads), levels, table_rows)
    words.unpersist()
    heads = _keys(heads, np.array([r[1] for r in top], np.int64), levels)
    by = np.argsort(heads)
    sorted_heads, head_symbol = heads[by], by

    def encoded_rows(table: pa.Table, told: pa.Table) -> pa.Table:
        parts = []
        for ids, learnt, hashes, tails, *rest in _batch_tokens(table):
            key, inverse = np.unique(_keys(hashes, tails, levels), return_inverse=True)
            parts.append((ids, learnt, key, inverse.astype(np.int32), _codes(hashes).astype(np.uint32), tails, *rest))
        keys = np.unique(np.concatenate([part[2] for part in parts]))
        head_of = np.full(len(keys), -1)
        known = B.among(keys, sorted_heads)
        head_of[known] = head_symbol[np.searchsorted(sorted_heads, keys[known])]
        answers = B.answers(told).reshape(-1, 2)
        first, counts = answers[:, 0] >= _FIRST, (answers[:, 0] & ~_FIRST).astype(np.int64)
        share = np.log10(np.maximum(counts, 1)) - np.log10(np.maximum(answers[:, 1], 1).astype(float))  # of its leaf
        owned = np.zeros((3, SYMBOLS), np.int64)  # per symbol: tokens, words, words seen once; of words first seen here
        rows = {n: [] for n in ("id", "held_out", "n_tokens", "n_known", "train_own", "log_counts", "log_tail", "symbols")}
        fresh = first & (counts > 0)
        for ids, learnt, key, inverse, codes, tails, is_end, cuts in parts:
            at = np.searchsorted(keys, key)[inverse]
            c = counts[at]
            head = head_of[at]
            symbols = np.where(is_end, END, np.where(head >= 0, head, tails))
            place = np.flatnonzero(fresh[at])
            place = place[np.unique(at[place], return_index=True)[1]]
            np.add.at(owned[0], symbols[place], c[place])
            np.add.at(owned[1], symbols[place], 1)
            np.add.at(owned[2], symbols[place], c[place] == 1)
            fresh[at] = False
            tail = symbols > END
            begins, sizes = cuts[:-1], np.diff(cuts)
            marked = (symbols.astype(np.uint32) | np.where(tail & (c == 0), _UNSEEN, np.uint32(0)) | codes << _CODE).tobytes()
            rows["id"] += ids.tolist()
            rows["held_out"] += (~learnt).tolist()
            rows["n_tokens"] += sizes.tolist()
            rows["n_known"] += np.add.reduceat((c > 0).astype(np.int64), begins).tolist()
            rows["train_own"] += np.where(learnt, sizes, 0).tolist()
            rows["log_counts"] += np.add.reduceat(np.log10(c + 1.0), begins).tolist()
            rows["log_tail"] += np.add.reduceat(np.where(tail & (c > 0), share[at], 0.0), begins).tolist()
            rows["symbols"] += [marked[4 * a:4 * b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        n = len(rows["id"])
        return pa.table({
            "doc_id": B.ids_of(np.array(rows["id"], np.int64)), "held_out": pa.array(rows["held_out"], pa.bool_()),
            **{k: pa.array(rows[k], pa.int64()) for k in ("n_tokens", "n_known", "train_own")},
            **{k: pa.array(rows[k], pa.float64()) for k in ("log_counts", "log_tail")},
            "owned": pa.array([owned.ravel().tolist()] + [None] * (n - 1), pa.list_(pa.int64())),
            "symbols": pa.array(rows["symbols"], pa.binary())})

    dealt, dealing = B.deal(docs)
    told = B.ask(dealt, lambda table: _count_keys(table, levels), dealing,
                 lambda keys, counts, cells: _total_counts(keys, counts, sorted_heads), width=2)
    encoded = checkpointed(dealt.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(encoded_rows, _ENCODED))
    stats = encoded.agg(F.sum("train_own"), F.sum(F.length("symbols"))).first()
    train_tokens, size = stats[0] or 0, stats[1] or 0
    owned = np.zeros(3 * SYMBOLS, np.int64)
    for at, n in encoded.select(F.posexplode("owned")).groupBy("pos").agg(F.sum("col")).collect():
        owned[at] = n
    tokens, types, once = owned.reshape(3, SYMBOLS)
    vocabulary = int(types.sum())
    model = new_model(tokens, branches)
    for _ in range(ROUNDS if train_tokens else 0):
        model = _mixed_models(encoded, model, max(1, -(-size // (TASK_BYTES // 2))))
    # Within a tail: the logarithms to add for a seen word, besides its digits and its share of their leaf, and for an unseen one.
    unseen = (once + 1) / (tokens + 2)
    seen_part = np.where(np.arange(SYMBOLS) > END, np.log10(1 - unseen), 0.0)
    unseen_part = np.where(np.arange(SYMBOLS) > END, np.log10(unseen / (types + 1)), 0.0)
    shipped = spark.sparkContext.broadcast((model, seen_part, unseen_part))
    base_share = np.log10(train_tokens + vocabulary + 1)

    def score(batches):
        model, seen_part, unseen_part = shipped.value
        for rows, symbols, codes, unseen, cuts in _parts(batches, False):
            p = np.concatenate([log_probabilities(model, *(v[cuts[a]:cuts[b]] for v in (symbols, codes, unseen)), cuts[a:b + 1] - cuts[a])
                                for a, b in _runs(cuts)])
            p += np.where(unseen, unseen_part[symbols], seen_part[symbols])
            logs = np.add.reduceat(p, cuts[:-1]) + rows.column("log_tail").to_numpy()
            n = rows.column("n_tokens").to_numpy()
            base = rows.column("log_counts").to_numpy() - n * base_share
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), rows.column("n_tokens"), rows.column("n_known"),
                 pa.array(np.full(len(n), train_tokens, np.int64)), pa.array(base), pa.array(logs)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return encoded.drop("owned").mapInArrow(score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                            "train_tokens bigint, base_score double, score double")


def _runs(cuts: np.ndarray, tokens: int = 1 << 15):
    """Runs of whole documents of about so many tokens."""
    start = 0
    while start < len(cuts) - 1:
        stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + tokens, side="right")) - 1)
        yield start, stop
        start = stop
