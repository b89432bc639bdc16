"""Removal of repeated byte strings by suffix sorting: shallow multikey passes, then blind tries."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabfeat.llm import blocks as B

GRAM = 20
_SLICE = 1 << 18
_POSITION = np.uint64(0xFFFFFFFF)
_SHALLOW = 16
RUNS_A_BATCH = 128  # distinct runs of one gram that a batch sends to the gram's bucket; with more the gram is heavy
RUNS = 4096  # distinct runs that a gram's bucket sorts; with more the gram is heavy
_HEAVY = np.uint64(2**64 - 1)
_BASES = (0x9E3779B97F4A7C55, 0xC2B2AE3D27D4EB4D)
_WINDOW = np.dtype([("a", "<u8"), ("b", "<u8"), ("id", "<i8")])


def deep_shallow(suffixes: np.ndarray, shallow: int = _SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and for each sorted row whether it differs from the one before.

    Shallow: a multikey sort with eight bytes as one character, each pass over the rows still tied.
    Deep: blind tries of all tied groups, grown together: a group skips what its rows have in common
    and branches on the first byte in which they differ.
    """
    rows, width = suffixes.shape
    order, head = np.arange(rows), np.zeros(rows, bool)
    head[:1] = True
    active = np.arange(rows)
    for depth in range(0, shallow, 8):
        if not len(active):
            return order, head
        group = np.cumsum(head)[active]
        word = np.ascontiguousarray(suffixes[order[active], depth:depth + 8]).view(">u8")[:, 0].astype(np.uint64)
        by = np.lexsort((word, group))
        order[active], word, group = order[active][by], word[by], group[by]
        head[active[1:]] |= (word[1:] != word[:-1]) & (group[1:] == group[:-1])
        active = _tied(head)
    while len(active):
        starts = np.flatnonzero(head[active])
        member = np.cumsum(head[active]) - 1
        own = suffixes[order[active]]
        differs = own != own[starts][member]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        branch = np.minimum.reduceat(common, starts)
        open_ = branch[member] < width
        active, member, own = active[open_], member[open_], own[open_]
        if not len(active):
            break
        byte = own[np.arange(len(own)), branch[member]]
        by = np.lexsort((byte, member))
        order[active], byte, member = order[active][by], byte[by], member[by]
        head[active[1:]] |= (byte[1:] != byte[:-1]) & (member[1:] == member[:-1])
        still = np.zeros(rows, bool)
        still[active] = True
        active = _tied(head)
        active = active[still[active]]
    return order, head


def _tied(head: np.ndarray) -> np.ndarray:
    """Sorted rows that stand in a group of two or more."""
    last = np.append(head[1:], True)
    return np.flatnonzero(~(head & last))


def _anchors(part: np.ndarray, at: np.ndarray, length: int, up: np.ndarray, down: np.ndarray):
    """Of each run of windows that choose the same gram: first and last window, the gram's place, two hashes.

    A window of ``length`` bytes chooses the gram with the smallest hash, the leftmost of equal ones, so
    equal windows choose alike wherever they stand. The second hash covers all bytes of the run.
    """
    n = len(part)
    starts = np.zeros(n, bool)
    counts = np.maximum(np.diff(at) - length + 1, 0)
    change = np.zeros(n + 1, np.int8)
    long = counts > 0
    change[at[:-1][long]] += 1
    change[(at[:-1] + counts)[long]] -= 1
    starts = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int8))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = B.prefix_sums(part, up)
    gram = (sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1]
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    least = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    span, width = length - GRAM + 1, 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    chosen = (least[starts] & _POSITION).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    first, last, place = starts[new], starts[np.append(new[1:], len(starts)) - 1], chosen[new]
    keys = B.between(sums, down, place, place + GRAM)
    whole = B.mixed(B.between(sums, down, first, last + length) + (place - first).astype(np.uint64))
    return first, last, place, keys, whole


class _Batch:
    """The runs of a batch's texts; equal runs are one entry, owned by the smallest id that has it."""

    def __init__(self, table: pa.Table, length: int, most: int):
        table = table.sort_by("id")  # stable: sorted rows keep their order
        self.ids = table["id"].to_numpy()
        self.data, self.offsets = B.flatten(table["text"])
        parts = list(B.slices(self.data, self.offsets, _SLICE))
        up, down = B.powers(max(len(p[2]) for p in parts) + 1)
        found = []
        for start, stop, part, at in parts:
            first, last, place, keys, whole = _anchors(part, at, length, up, down)
            row = start + np.searchsorted(at, first, side="right") - 1
            found.append((first + self.offsets[start], last + self.offsets[start], row, keys, whole))
        self.first, self.last, self.row, keys, whole = (np.concatenate(x) for x in zip(*found))
        own = self.ids[self.row]
        order = np.lexsort((own, whole, keys))
        keys, whole = keys[order], whole[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(new)
        self.keys, self.whole, self.owner_at = keys[at], whole[at], order[at]
        self.owner = own[self.owner_at]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.own = own
        # Of a gram with more than ``most`` distinct runs one mark is sent.
        head = np.ones(len(at), bool)
        head[1:] = self.keys[1:] != self.keys[:-1]
        gram = np.cumsum(head) - 1
        self.light = np.bincount(gram, minlength=1)[gram] <= most
        self.sent = self.light | head

    def run_keys(self) -> np.ndarray:
        return np.column_stack([self.keys, np.where(self.light, self.whole, _HEAVY)])[self.sent].ravel()

    def flags(self, answered: np.ndarray) -> np.ndarray:
        """The answers to ``run_keys`` for every distinct run."""
        return np.where(self.light, answered[np.cumsum(self.sent) - 1], np.uint8(4)) if len(self.sent) else answered

    def windows(self, flags: np.ndarray, length: int):
        """The distinct windows in runs of heavy grams with their smallest ids, sorted by hash.

        With them for each window its entry, its number in the run, whether a smaller id here has it, and its place among the distinct ones.
        """
        widest = 2 * length - GRAM
        heavy = np.flatnonzero(flags & 5 == 4)
        powers = [_small_powers(base, widest) for base in _BASES]
        found, entries, bits = [np.zeros(0, _WINDOW)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(heavy), 1 << 14):
            entry = heavy[start:start + (1 << 14)]
            place = self.owner_at[entry]
            first = self.first[place]
            inside = np.arange(widest - length + 1) <= (self.last[place] - first)[:, None]
            own = self.data[np.minimum(first[:, None] + np.arange(widest), len(self.data) - 1)].astype(np.uint64) + np.uint64(1)
            row, bit = np.nonzero(inside)
            part = np.zeros(len(row), _WINDOW)
            for name, (up, down) in zip("ab", powers):
                sums = np.zeros((len(entry), widest + 1), np.uint64)
                np.cumsum(own * up, axis=1, out=sums[:, 1:])
                part[name] = B.mixed((sums[:, length:] - sums[:, :-length]) * down[:widest - length + 1])[inside]
            part["id"] = self.owner[entry[row]]
            found.append(part)
            entries.append(entry[row])
            bits.append(bit)
        windows = np.concatenate(found)
        order, least, new = _least_ids(windows)
        at, inverse = order[new], np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        later = np.empty(len(order), bool)
        later[order] = least < windows["id"][order]
        return windows[at], np.concatenate(entries), np.concatenate(bits), later, inverse


def _small_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    return (np.array([pow(base, i, 1 << 64) for i in range(n)], np.uint64),
            np.array([pow(inverse, i, 1 << 64) for i in range(n)], np.uint64))


def _least_ids(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the windows by hash and id, the smallest id of each sorted window, and where a new one begins."""
    order = np.lexsort((windows["id"], windows["b"], windows["a"]))
    a, b, ids = (windows[c][order] for c in ("a", "b", "id"))
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(ids) else ids, new


def _compare_runs(keys: np.ndarray, counts: np.ndarray, cells: np.ndarray, most: int = RUNS) -> list[np.ndarray]:
    """1: a batch of an earlier cell has the same run; 2: the gram stands in different runs; 4: in too many for one bucket."""
    gram, whole = keys[::2], keys[1::2]
    order = np.lexsort((whole, gram))
    gram, whole = gram[order], whole[order]
    flags = np.zeros(len(order), np.uint8)
    if len(order):
        same_gram = np.concatenate([[False], gram[1:] == gram[:-1]])
        same = same_gram & np.concatenate([[False], whole[1:] == whole[:-1]])
        start = np.flatnonzero(~same_gram)
        runs = np.add.reduceat(~same, start)
        heavy = (runs > most) | np.logical_or.reduceat(whole == _HEAVY, start)
        cell = np.repeat(cells, counts)[order]  # ascends within equal runs
        later = cell > cell[np.flatnonzero(~same)][np.cumsum(~same) - 1]
        flags[order] = later + (2 * (runs > 1) + 4 * heavy).astype(np.uint8)[np.cumsum(~same_gram) - 1]
    return B.split_like(flags, counts)


def remove_repeated_strings(docs: DataFrame, length: int = 50, keep_text: bool = False,
                            carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove each byte covered by a ``length``-byte string that also starts in a document with a smaller doc_id.

    Texts are UTF-8 bytes, matches never cross documents, and strings are judged on the input. Windows
    fall into runs by the gram they choose. A run that an earlier document has whole goes whole; runs
    that share a gram but differ are sent to the gram's bucket, where the suffixes that start their
    windows are sorted and equal neighbours give way to the smallest doc_id. A gram with more runs than
    one bucket should sort is heavy: the windows of its runs are dealt by two 64-bit hashes of all their
    bytes, each once per batch with its smallest doc_id, so that only equal windows need to meet.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (and
    kept_text on request, without the characters that a cut broke; columns in ``carry`` come as one struct). A null text is empty; rows with the
    same doc_id never remove each other's bytes; a null doc_id counts as larger than any other. Other
    columns are ignored.
    """
    if not GRAM < length <= GRAM + 32:
        raise ValueError(f"the length must be from {GRAM + 1} to {GRAM + 32}")
    widest = 2 * length - GRAM
    record = np.dtype([("id", "<i8"), ("n", "<u2"), ("bytes", "u1", (widest,))])
    dealt, dealing = B.deal(docs, carry=carry)
    buckets = len(dealing)
    a_batch, a_gram = RUNS_A_BATCH, RUNS

    def run_keys(table: pa.Table) -> np.ndarray:
        return _Batch(table, length, a_batch).run_keys()

    def compare(keys: np.ndarray, counts: np.ndarray, cells: np.ndarray) -> list[np.ndarray]:
        return _compare_runs(keys, counts, cells, a_gram)

    def contested(table: pa.Table, told: pa.Table) -> pa.Table:
        """Runs that this batch owns and that differ from others with their gram, and a note for itself."""
        batch = _Batch(table, length, a_batch)
        flags = batch.flags(B.answers(told, np.uint8))
        at = np.flatnonzero(flags == 2)
        place = batch.owner_at[at]
        first, size = batch.first[place], batch.last[place] - batch.first[place] + length
        records = np.zeros(len(at), record)
        records["id"], records["n"] = batch.owner[at], size
        inside = np.arange(widest) < size[:, None]
        source = first[:, None] + np.arange(widest)
        records["bytes"][inside] = batch.data[source[inside]]
        del source, inside
        # The suffixes take far more room than the runs, so their buckets are smaller.
        cuts = np.searchsorted(B.bucket_of(batch.keys[at], 8 * buckets), np.arange(8 * buckets + 1))
        there = np.flatnonzero(np.diff(cuts)).tolist()
        number = table["batch"][0].as_py()
        packed = [records[cuts[b]:cuts[b + 1]].tobytes() for b in there]
        windows = batch.windows(flags, length)[0]
        cuts = np.searchsorted(B.bucket_of(windows["a"], 8 * buckets), np.arange(8 * buckets + 1))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        packed += [windows[cuts[b]:cuts[b + 1]].tobytes() for b in full]
        there += [8 * buckets + b for b in full]
        return pa.table({"bucket": pa.array([*there, -1 - number], pa.int32()),
                         "batch": pa.array([number] * (len(there) + 1), pa.int32()),
                         "keys": pa.array([*packed, flags.tobytes()], pa.binary())})

    def sorted_suffixes(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            return table.select(["batch", "bucket", "keys"]).rename_columns(["batch", "bucket", "answer"])
        heavy = table["bucket"][0].as_py() >= 8 * buckets
        blocks = [np.frombuffer(k, _WINDOW if heavy else record) for k in table["keys"].to_pylist()]
        found = (_later_windows if heavy else _repeats)(np.concatenate(blocks), length)
        return pa.table({"batch": table["batch"], "bucket": table["bucket"], "answer": pa.array(
            [x.tobytes() for x in B.split_like(found, np.array([len(b) for b in blocks]))], pa.binary())})

    def cleaned(table: pa.Table, told: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        batch = _Batch(table, length, a_batch)
        told = told.sort_by("bucket")
        flags = np.frombuffer(told["answer"][0].as_py(), np.uint8)
        masks = np.zeros(len(flags), np.uint32)
        light = np.searchsorted(told["bucket"].to_numpy(), 8 * buckets)
        masks[flags == 2] = B.answers(told.slice(1, light - 1), np.uint32)
        _, entry, bit, later, inverse = batch.windows(flags, length)
        hit = later | (B.answers(told.slice(light), np.uint8) > 0)[inverse]
        np.bitwise_or.at(masks, entry[hit], np.uint32(1) << bit[hit].astype(np.uint32))
        whole = (flags[batch.entry] & 1 > 0) | (batch.own > batch.owner[batch.entry])
        change = np.zeros(len(batch.data) + 1, np.int32)
        np.add.at(change, batch.first[whole], 1)
        np.add.at(change, batch.last[whole] + length, -1)
        part = np.flatnonzero(~whole & (masks[batch.entry] > 0))
        bit, which = np.nonzero((masks[batch.entry[part]] >> np.arange(32, dtype=np.uint32)[:, None]) & np.uint32(1))
        windows = batch.first[part[which]] + bit
        np.add.at(change, windows, 1)
        np.add.at(change, windows + length, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        head = gone.copy()
        head[1:] &= ~gone[:-1]
        begins = batch.offsets[:-1][batch.offsets[:-1] < len(gone)]
        head[begins] = gone[begins]
        removed, spans = _counted(gone)[batch.offsets], _counted(head)[batch.offsets]
        left, cuts = batch.data[~gone].tobytes(), (batch.offsets - removed).tolist()
        texts = [left[a:b] for a, b in zip(cuts, cuts[1:])]
        columns = {"doc_id": B.ids_of(batch.ids), "n_bytes": pa.array(np.diff(batch.offsets)),
                   "n_removed": pa.array(np.diff(removed).astype(np.int64)), "n_spans": pa.array(np.diff(spans).astype(np.int64)),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}
        if keep_text:
            columns["kept_text"] = pa.array([t.decode(errors="ignore") for t in texts], pa.string())
        if carry:
            columns["carry"] = table["carry"]
        return pa.table(columns)

    flags = B.ask(dealt, run_keys, dealing, compare, width=2)
    groups = dealt.groupBy("batch")
    told = (groups.cogroup(flags.groupBy("batch")).applyInArrow(contested, B.PACKED)
            .groupBy("bucket").applyInArrow(sorted_suffixes, B.ANSWER))
    schema = T.StructType.fromDDL("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
                                  + ", kept_text string" * keep_text)
    if carry:
        schema.add(dealt.schema["carry"])
    return groups.cogroup(told.groupBy("batch")).applyInArrow(cleaned, schema)


def _counted(marks: np.ndarray) -> np.ndarray:
    """How many marks there are before each place."""
    sums = np.zeros(len(marks) + 1, np.int64 if len(marks) >> 31 else np.int32)
    np.cumsum(marks, out=sums[1:])
    return sums


def _repeats(records: np.ndarray, length: int) -> np.ndarray:
    """Per record a bit for each window that a smaller id has too."""
    windows = records["n"].astype(np.int64) - length + 1
    owner = np.repeat(np.arange(len(records)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    suffixes = np.lib.stride_tricks.sliding_window_view(records["bytes"], length, axis=1)[owner, offset]
    order, head = deep_shallow(suffixes)
    ids = records["id"][owner[order]]
    least = np.minimum.reduceat(ids, np.flatnonzero(head))[np.cumsum(head) - 1]
    hit = order[least < ids]
    masks = np.zeros(len(records), np.uint32)
    np.bitwise_or.at(masks, owner[hit], np.uint32(1) << offset[hit].astype(np.uint32))
    return masks


def _later_windows(windows: np.ndarray, length: int) -> np.ndarray:
    """Whether a smaller id has the window too."""
    order, least, _ = _least_ids(windows)
    found = np.empty(len(order), np.uint8)
    found[order] = least < windows["id"][order]
    return found
