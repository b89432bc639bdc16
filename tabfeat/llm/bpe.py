"""Byte-level BPE: frequent words from a minimal acyclic transducer, all others merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabfeat.llm import blocks as B
from tabfeat.session import shared_folder

#: Fixed value: how texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEXICON_WORDS = 1 << 15
WORD_SHARE = 2e-6  # a word with this share of the corpus has it in some task too, and is counted there
_REMEMBERED = 400_000
_REMEMBERED_BYTES = 64 << 20
_LONG = 48  # bytes of a word that is merged by itself
_NEVER = 2**62


# --- vocabulary ---------------------------------------------------------------------------

def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, following = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in plain else following))
        following += byte not in plain
    return letters


class Vocabulary:
    """Token bytes, merge ranks and special texts of a tokenizer file; its size bounds what tasks receive."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        vocab = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        tokens = {i: bytes(byte_of[c] for c in text) for text, i in vocab.items()}
        tokens |= {i: text.encode() for text, i in self.special.items()}
        self.tokens = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.single = [vocab[letter] for letter in byte_letters()]
        self.merges = {}
        for rank, (a, b) in enumerate(content["model"]["merges"]):
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        known = sorted((a * len(self.tokens) + b, rank) for (a, b), (rank, _) in self.merges.items())
        self.pairs, self.pair_ranks = np.array(known, np.int64).reshape(-1, 2).T.copy()
        self.merged = np.zeros(len(content["model"]["merges"]), np.int64)
        for rank, token in self.merges.values():
            self.merged[rank] = token

    @classmethod
    def of(cls, state: dict) -> Vocabulary:
        """From the attributes of another one: a broadcast holds plain values only."""
        vocabulary = cls.__new__(cls)
        vars(vocabulary).update(state)
        return vocabulary

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank at which each pair is merged, _NEVER for a pair that isn't."""
        if not len(self.pairs):
            return np.full(len(left), _NEVER)
        key = left * len(self.tokens) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], _NEVER)

    def merge(self, word: bytes) -> list[int]:
        return self.merge_all([word])[0]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word: the pair that was learnt first is merged first, the leftmost of equal ones.

        All words that aren't long take their next merge together, until none has one left.
        """
        merged: list[list[int]] = [[] for _ in words]
        number = np.array([i for i, w in enumerate(words) if 0 < len(w) <= _LONG], np.int64)
        for i, word in enumerate(words):
            if len(word) > _LONG:
                merged[i] = self._merge_long([self.single[b] for b in word])
        sizes = np.array([len(words[i]) for i in number.tolist()], np.int64)
        data = np.frombuffer(b"".join(words[i] for i in number.tolist()), np.uint8)
        ids = np.array(self.single, np.int64)[data]
        rank = np.append(self._ranks(ids[:-1], ids[1:]), _NEVER)[:len(ids)]
        rank[np.cumsum(sizes) - 1] = _NEVER  # the last token of a word has no partner
        while len(number):
            owner = np.repeat(np.arange(len(number)), sizes)
            best = np.minimum.reduceat(rank, np.cumsum(sizes) - sizes)
            done = best == _NEVER
            if done.any():
                left = ids[done[owner]].tolist()
                ends = np.cumsum(sizes[done]).tolist()
                for i, start, stop in zip(number[done].tolist(), [0, *ends], ends):
                    merged[i] = left[start:stop]
                go = ~done[owner]
                ids, rank, number, sizes, best = ids[go], rank[go], number[~done], sizes[~done], best[~done]
                owner = np.repeat(np.arange(len(number)), sizes)
            hit = np.flatnonzero(rank == best[owner])
            at = hit[np.diff(owner[hit], prepend=-1) > 0]  # the leftmost of each word
            ids[at] = self.merged[best]
            rank[at] = _NEVER
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, rank, sizes = ids[stay], rank[stay], sizes - 1
            at -= np.arange(len(at))
            ends = np.cumsum(sizes)
            right = at[at + 1 < ends]
            left = at[at > ends - sizes] - 1
            place = np.concatenate([right, left])
            rank[place] = self._ranks(ids[place], ids[place + 1])
        return merged

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs and a chain of places, for words of any length."""
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        ids, heap = list(ids), []

        def offer(i):
            if i >= 0 and after[i] >= 0 and (found := self.merges.get((ids[i], ids[after[i]]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]], found[1]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = after[i] if i >= 0 else -1
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]


# --- transducer ---------------------------------------------------------------------------

class Transducer:
    """A minimal acyclic automaton over bytes: the outputs on a word's path add up to its number.

    States are numbered so that equal ends of words are one state. Edges are sorted by state and byte;
    the numbers point into the words' ids. All of it is one flat array that tasks map into memory.
    """

    def __init__(self, flat: np.ndarray):
        sizes = flat[:4].tolist()
        cuts = np.cumsum([4, sizes[0], sizes[0], sizes[0], sizes[1], sizes[2], sizes[3]])
        self.keys, self.targets, self.outputs, self.final, self.offsets, self.ids = (
            flat[a:b] for a, b in zip(cuts, cuts[1:]))

    @staticmethod
    def compile(words: list[bytes], ids_of) -> np.ndarray:
        """The flat array of sorted distinct words, built word by word with a register of finished states."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, target), …))
        accepted: list[int] = []
        path: list[list] = [[False, []]]  # the states of the last word, not yet finished

        def finish(node) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
                accepted.append(key[0] + sum(accepted[t] for _, t in key[1]))
            return register[key]

        def close(depth: int, last: bytes) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], finish(node)))

        last = b""
        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            close(common, last)
            path.extend([False, []] for _ in word[common:])
            path[-1][0] = True
            last = word
        close(0, last)
        start = finish(path[0])
        keys, targets, outputs = [], [], []
        number = {start: 0} | {s: i for i, s in enumerate([s for s in range(len(states)) if s != start], 1)}
        for state in sorted(number, key=number.get):
            final, edges = states[state]
            passed = int(final)
            for byte, target in edges:
                keys.append(number[state] << 8 | byte)
                targets.append(number[target])
                outputs.append(passed)
                passed += accepted[target]
        final = [int(states[s][0]) for s in sorted(number, key=number.get)]
        found = [ids_of(w) for w in words]
        offsets = np.concatenate([[0], np.cumsum([len(i) for i in found])])
        ids = [i for one in found for i in one]
        return np.concatenate([np.array(x, np.int64) for x in (
            [len(keys), len(final), len(offsets), len(ids)], keys, targets, outputs, final, offsets, ids)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the automaton doesn't accept it; all words step together."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.arange(len(words)) if len(self.keys) else np.zeros(0, np.int64)
        dead = np.full(len(words), not len(self.keys))
        step = 0
        while len(alive := alive[sizes[alive] > step]):
            key = state[alive] << 8 | data[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[at] == key
            dead[alive[~there]] = True
            alive, at = alive[there], at[there]
            number[alive] += self.outputs[at]
            state[alive] = self.targets[at]
            step += 1
        return np.where(dead | (self.final[state] == 0), -1, number)


# --- texts --------------------------------------------------------------------------------

class _Numbered(dict):
    held = 0  # characters of all keys

    def __missing__(self, key):
        self[key] = number = len(self)
        self.held += len(key)
        return number


class Encoder:
    """Encodes and decodes slices of texts, remembering the words that it has met."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer):
        self.vocabulary, self.transducer = vocabulary, transducer
        self.cut = regex.compile(PATTERN).findall
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")").split if vocabulary.special else None
        self.token_sizes = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.token_begins = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.chunks, self.words, self.held = _Numbered(), {}, 0
        self.chunk_ids, self.sizes, self.odd = [], np.zeros(0, np.int64), np.zeros(0, bool)
        self.flat = np.zeros(0, np.uint32)

    def _learn_words(self, words) -> None:
        """Ids of words that weren't met before: from the transducer, or merged."""
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        if not new:
            return
        raw = [w.encode() for w in new]
        self.held += sum(map(len, raw))
        numbers = self.transducer.numbers(raw)
        cuts, ids = self.transducer.offsets, self.transducer.ids
        unseen = iter(self.vocabulary.merge_all([raw[i] for i in np.flatnonzero(numbers < 0).tolist()]))
        for word, number in zip(new, numbers.tolist()):
            self.words[word] = next(unseen) if number < 0 else ids[cuts[number]:cuts[number + 1]].tolist()

    def _learn_chunks(self) -> None:
        """Chunks begin with the space before them. One that touches more white space can't be cut alone."""
        new = list(islice(self.chunks, len(self.sizes), None))
        cut = [self.cut(c) for c in new]
        self._learn_words(w for words in cut for w in words)
        ids = [[i for w in words for i in self.words[w]] for words in cut]
        self.sizes = np.concatenate([self.sizes, np.array([len(i) for i in ids], np.int64)])
        self.flat = np.concatenate([self.flat, np.array([i for one in ids for i in one], np.uint32)])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.odd = np.concatenate([self.odd, np.array([c[-1:].isspace() or c[1:2].isspace() for c in new], bool)])

    def _whole(self, text: str) -> np.ndarray:
        """A text with special strings or repeated white space, cut as a whole."""
        ids = []
        for part in self.special(text) if self.special else [text]:
            if part in self.vocabulary.special:
                ids.append(self.vocabulary.special[part])
            else:
                words = self.cut(part)
                self._learn_words(words)
                ids.extend(i for w in words for i in self.words[w])
        return np.array(ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # Words are parts of chunks, or of texts that were cut as a whole.
        if max(len(self.chunks), len(self.words)) > _REMEMBERED or self.chunks.held + self.held > _REMEMBERED_BYTES:
            self.forget()
        alone = [any(s in t for s in self.vocabulary.special) or "\0" in t for t in texts]
        chunks = [[] if not t or a else t.replace(" ", "\0 ").split("\0") for t, a in zip(texts, alone)]
        for one in chunks:
            if one and not one[0]:
                del one[0]  # the text begins with a space
        counts = np.array([len(c) for c in chunks], np.int64)
        numbers = np.fromiter((n for c in chunks for n in map(self.chunks.__getitem__, c)), np.int64, int(counts.sum()))
        if len(self.chunks) > len(self.sizes):
            self._learn_chunks()
        sizes = self.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.begins[numbers] - ends[:-1], sizes) + np.arange(ends[-1])] if len(numbers) else self.flat[:0]
        rows = np.concatenate([[0], np.cumsum(counts)])
        odd = np.concatenate([[0], np.cumsum(self.odd[numbers])])[rows]
        alone = np.array(alone, bool) | (np.diff(odd) > 0)
        cuts = ends[rows].tolist()
        return [self._whole(t) if a else ids[x:y] for t, a, x, y in zip(texts, alone.tolist(), cuts, cuts[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of the decoded text; what isn't valid UTF-8 becomes U+FFFD."""
        sizes = self.token_sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.token_bytes[np.repeat(self.token_begins[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        return data.decode("utf-8", errors="replace").encode()


def _frequent(share: float):
    """Words with at least this share of the task's words, and their counts."""
    def words(batches):
        cut, counts, total = regex.compile(PATTERN).findall, Counter(), 0
        for batch in batches:
            for start, stop, part, at in B.slices(*B.flatten(batch.column("text"))):
                for text in batch.column("text").slice(start, stop - start).to_pylist():
                    chunks = (text or "").replace(" ", "\0 ").split("\0")
                    total += len(chunks)
                    counts.update(chunks)
            # What is rarer than the share by now can only reach it by coming often later: it starts anew.
            if len(counts) > _REMEMBERED:
                counts = Counter({w: n for w, n in counts.items() if n >= share * total})
        words: dict[str, int] = {}
        for chunk, n in counts.items():
            if n >= share * total and n > 1:
                for word in cut(chunk):
                    words[word] = words.get(word, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])
    return words


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, words: int = LEXICON_WORDS) -> str:
    """Compile the corpus's most frequent words and hand the file to all tasks; returns its name.

    Counting covers every text; ``words`` bounds the lexicon, which saves work and never changes an id.
    """
    spark = docs.sparkSession
    top = (docs.select("text").mapInArrow(_frequent(WORD_SHARE), "word string, n bigint")
           .groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words).collect())
    frequent = sorted(r[0].encode() for r in top)
    flat = Transducer.compile(frequent, dict(zip(frequent, vocabulary.merge_all(frequent))).get)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    out.write(bytearray(flat.astype("<i8").tobytes()))
    out.close()
    spark.sparkContext.addFile(path)
    return name


def encode_documents(docs: DataFrame, path: str, keep_ids: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode every whole text with the byte-level BPE of a tokenizer file, and decode it again.

    One row per input row: the columns in ``keep``, n_tokens, ids_sha256 (ids as little-endian 32-bit
    numbers), decoded_sha256 (and on request ``ids`` as these bytes and ``decoded``). A null text is
    empty and has no tokens. The strings of special tokens become their ids. Other columns are ignored.
    """
    B.bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    shipped = spark.sparkContext.broadcast(vars(vocabulary))
    lexicon = build_lexicon(docs, vocabulary)

    def encode(batches):
        from pyspark import SparkFiles
        encoder = Encoder(Vocabulary.of(shipped.value), Transducer(np.memmap(SparkFiles.get(lexicon), np.int64, "r")))
        for batch in batches:
            for start, stop, _, _ in B.slices(*B.flatten(batch.column("text")), 1 << 20):
                rows = batch.slice(start, stop - start)
                ids = encoder.encode([t or "" for t in rows.column("text").to_pylist()])
                raw = [i.astype("<u4").tobytes() for i in ids]
                decoded = [encoder.decode(i) for i in ids]
                columns = [rows.column(c) for c in keep] + [
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())]
                if keep_ids:
                    columns += [pa.array(raw, pa.binary()), pa.array([d.decode() for d in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])]
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["n_tokens bigint, ids_sha256 string, decoded_sha256 string"])
    schema += ", ids binary, decoded string" * keep_ids
    return docs.select(*keep, "text").mapInArrow(encode, schema)
