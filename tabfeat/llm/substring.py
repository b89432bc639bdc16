"""Removal of repeated word windows, found by difference-cover anchors."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabfeat.llm import blocks as B

PERIOD = 7
_ANEW = np.uint64(0xC2B2AE3D27D4EB4F)
COVER = (0, 1, 3)  # every difference modulo 7 occurs between two of these


def _slices(table: pa.Table, window: int, anchors: bool):
    """Word spans and hashes of the batch's texts, a slice at a time."""
    table = table.sort_by("id")
    ids, (data, offsets) = table["id"].to_numpy(), B.flatten(table["text"])
    for start, stop, part, at in B.slices(data, offsets):
        padded, starts, stops, first = B.words(part, at, B.SPACED)
        word = B.range_hashes(padded, starts, stops)
        power = B.powers(len(word) + 1)
        row = np.repeat(np.arange(stop - start), np.diff(first))
        found = {"ids": ids[start:stop], "padded": padded, "starts": starts, "stops": stops, "first": first,
                 "row": row, "word": word, "power": power}
        if anchors:
            span = window - PERIOD + 1
            cover = np.isin((np.arange(len(word)) - first[row]) % PERIOD, COVER)
            found["anchors"] = at = np.flatnonzero(cover & B.window_rows(first, span))
            found["anchor_keys"] = B.range_hashes(word, at, at + span, power, 1)
        else:
            found["windows"] = at = np.flatnonzero(B.window_rows(first, window))
            found["window_keys"], found["checks"] = _window_hashes(word, at, window, power)
        yield found


def _window_hashes(word: np.ndarray, at: np.ndarray, window: int, power) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window: the words' hashes are mixed anew for the second."""
    return (B.range_hashes(word, at, at + window, power, 2),
            B.range_hashes(B.mixed(word ^ _ANEW), at, at + window, power, 2))


def _ids_of_keys(parts: list[dict], places: str, keys: str):
    return B.least_and_most(np.concatenate([p[keys] for p in parts]),
                            np.concatenate([p["ids"][p["row"][p[places]]] for p in parts]))


def remove_repeated_windows(docs: DataFrame, window: int = 13, keep_text: bool = False) -> DataFrame:
    """Remove each word covered by a window of words that also starts in a document with a smaller doc_id.

    Words are runs without ASCII white space; windows are judged on the input. Anchors are hashed only
    where the word's number modulo 7 lies in a difference cover: any two equal windows hold an anchor
    of ``window - 6`` words at the same offset. Around the anchors that another document has too, the
    whole windows are compared, by two 64-bit hashes across batches.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 (and kept_text on request: words
    joined by one space). A null or empty text has no words; rows with the same doc_id never remove
    each other's words; a null doc_id counts as larger than any other. Other columns are ignored.
    """
    if window < PERIOD:
        raise ValueError(f"a window needs at least {PERIOD} words")
    dealt, dealing = B.deal(docs)

    def anchor_keys(table: pa.Table) -> np.ndarray:
        return np.unique(np.concatenate([p["anchor_keys"] for p in _slices(table, window, True)]))

    def candidate_keys(table: pa.Table, told: pa.Table) -> np.ndarray:
        parts = list(_slices(table, window, True))
        keys, least, most = _ids_of_keys(parts, "anchors", "anchor_keys")
        shared = np.union1d(B.answers(told), keys[least != most])
        found = []
        for p in parts:
            # An anchor at word a lies in the windows that start at a - 6 … a.
            marks = np.zeros(len(p["word"]), bool)
            marks[p["anchors"][B.among(p["anchor_keys"], shared)]] = True
            near = B.covered(marks[::-1], PERIOD)[::-1]
            at = np.flatnonzero(near & B.window_rows(p["first"], window))
            found.append(np.column_stack(_window_hashes(p["word"], at, window, p["power"])))
        pairs = np.concatenate(found)
        return pairs[B.new_pairs(pairs[:, 0], pairs[:, 1])].ravel()

    def cleaned(table: pa.Table, told: pa.Table) -> pa.Table:
        parts = list(_slices(table, window, False))
        keys, least, most = _ids_of_keys(parts, "windows", "window_keys")
        # Two hashes of one window are in the same pair but for a chance far below one in 2^64.
        earlier, checks = np.sort(B.answers(told).reshape(-1, 2), axis=0).T
        twice = least != most
        keys, least = keys[twice], least[twice]
        rows = {"id": [], "n_words": [], "n_removed": [], "text": []}
        for p in parts:
            own = p["ids"][p["row"][p["windows"]]]
            here = B.among(p["window_keys"], keys)
            here[here] = least[np.searchsorted(keys, p["window_keys"][here])] < own[here]
            marks = np.zeros(len(p["word"]), bool)
            marks[p["windows"][here | (B.among(p["window_keys"], earlier) & B.among(p["checks"], checks))]] = True
            kept = ~B.covered(marks, window)
            first = p["first"]
            sums = np.concatenate([[0], np.cumsum(kept)])[first]
            rows["id"] += p["ids"].tolist()
            rows["n_words"] += np.diff(first).tolist()
            rows["n_removed"] += (np.diff(first) - np.diff(sums)).tolist()
            # A kept word goes on with the single space behind it.
            padded, at, lengths = p["padded"], p["starts"][kept], (p["stops"] - p["starts"])[kept] + 1
            ends = np.concatenate([[0], np.cumsum(lengths)])
            out = padded[np.repeat(at - ends[:-1], lengths) + np.arange(ends[-1])].tobytes()
            cuts = ends[sums].tolist()
            rows["text"] += [out[a:max(a, b - 1)] for a, b in zip(cuts, cuts[1:])]
        columns = {"doc_id": B.ids_of(np.array(rows["id"], np.int64)), "n_words": pa.array(rows["n_words"], pa.int64()),
                   "n_removed": pa.array(rows["n_removed"], pa.int64()),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in rows["text"]], pa.string())}
        if keep_text:
            columns["kept_text"] = pa.array([t.decode() for t in rows["text"]], pa.string())
        return pa.table(columns)

    anchors = B.ask(dealt, anchor_keys, dealing, B.shared_keys)
    earlier = B.ask(dealt, candidate_keys, dealing, B.later_pairs, width=2, told=anchors)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * keep_text
    return dealt.groupBy("batch").cogroup(earlier.groupBy("batch")).applyInArrow(cleaned, schema)
