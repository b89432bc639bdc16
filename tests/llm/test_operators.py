"""The text operators against plain versions, on the smallest tables and on edge cases."""

import hashlib
import math
import random
import time

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabfeat.llm import blocks, bpe, language_id, maxent, minhash, queries, suffix_array
from tabfeat.llm.bpe import Encoder, Transducer, Vocabulary, encode_documents
from tabfeat.llm.chat import format_conversations
from tabfeat.llm.components import components
from tabfeat.llm.decontamination import find_benchmark_windows
from tabfeat.llm.language_id import _gradient, _new_network, identify_language, keep_identified, label_positions
from tabfeat.llm.maxent import score_texts
from tabfeat.llm.minhash import near_duplicates
from tabfeat.llm.quality import score_quality
from tabfeat.llm.simhash import distance, document_links, edited_neighbours, within_radius
from tabfeat.llm.substring import remove_repeated_windows

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, keys int, score double"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_id(df):
    rows = df.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").cache()


@pytest.fixture(scope="module")
def pairs(documents):
    return [tuple(r) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd_rows():
    """Null, empty, long, repeated and nearly repeated texts, ties and strange characters."""
    rng = random.Random(5)
    words = [rng.choice(["the", "Der", "été", "señor", "x1", "漢字", "a,b", "!!"]) + str(rng.randint(0, 40)) for _ in range(400)]
    base = " ".join(words[:120])
    near = " ".join(words[:60] + ["new"] + words[61:120])
    texts = [None, "", " \n\t ", base, base, near, base.upper(), "one two", "one two", "one two three", base + " " + " ".join(words[200:260]),
             "x" * 300, "y" * 10 + "x" * 300, " ".join(words * 60), " ".join(words[200:230]) + "  é<|endoftext|> 's  end\n\n", "1234 5678", base]
    return [(10 * i + 1, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, ("en", "de", None)[k % 3], "s", None, "w", 3, 0.5) for k, (i, t) in enumerate(odd_rows)], SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(10 * i + 1, i % 2, 0) for i in range(12)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "one two"), (2, "the0 Der1"), (3, None), (4, ""), (None, "one two three"), (2, "the0 Der1")], "item_id bigint, text string")


def test_substring(documents, pairs, odd, odd_rows):
    assert by_id(remove_repeated_windows(documents)) == brute.substring(pairs)
    assert by_id(remove_repeated_windows(odd)) == brute.substring(odd_rows)
    assert by_id(remove_repeated_windows(odd, 8)) == brute.substring(odd_rows, 8)


def test_suffix_array(documents, pairs, odd, odd_rows):
    few = documents.where("doc_id < 80")
    assert by_id(suffix_array.remove_repeated_strings(few)) == brute.byte_strings([p for p in pairs if p[0] < 80])
    assert by_id(suffix_array.remove_repeated_strings(odd)) == brute.byte_strings(odd_rows)


def _hot_rows(n=600):
    """A third of the rows without an id, a third with one id; many copies, one text far longer than the others."""
    rng = random.Random(8)
    shared = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(40)) for _ in range(8)]
    rows = []
    for k in range(n):
        text = " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 60))) + " " + rng.choice(shared) * (k % 4 > 0)
        rows.append(((None, 700, 3 * k)[k % 3], text))
    return [*rows, (5, " ".join(f"long{i}" for i in range(3000)) + " " + shared[0])]


def _removed_of_rows(rows, k, items):
    """Numbers of covered positions; rows of one id judge by the smaller ids only, no id is larger than any."""
    texts = [(math.inf if i is None else i, items(t)) for i, t in rows]
    first = {}
    for i, w in texts:
        for p in range(len(w) - k + 1):
            first[w[p:p + k]] = min(i, first.get(w[p:p + k], math.inf))
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - k + 1):
            if first[w[p:p + k]] < i:
                gone.update(range(p, p + k))
        out.append((i, len(w), len(gone)))
    return sorted(out)


def test_ids_with_a_third_of_all_rows(spark):
    rows = _hot_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for removed, k, items in ((remove_repeated_windows(docs), 13, lambda t: tuple(t.split())),
                              (suffix_array.remove_repeated_strings(docs), 50, str.encode)):
        found = sorted((math.inf if r[0] is None else r[0], r[1], r[2]) for r in removed.collect())
        assert found == _removed_of_rows(rows, k, items)


def test_windows_with_one_hash_in_common_are_not_the_same():
    keys = np.array([[1, 7], [2, 7], [1, 7], [1, 8], [2, 7]], np.uint64)
    found = blocks.later_pairs(keys.ravel(), np.array([2, 2, 1]), np.array([0, 1, 1]))
    assert [f.tolist() for f in found] == [[], [1, 7], [2, 7]]
    # Batches of one cell hold one id, so they don't come before each other.
    assert [f.tolist() for f in blocks.later_pairs(keys.ravel(), np.array([2, 2, 1]), np.array([3, 3, 3]))] == [[], [], []]


@pytest.mark.parametrize("batch_bytes", [2_000, 12_000])
def test_batches_are_bounded_in_bytes_whatever_the_ids(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(blocks, "MIN_BATCHES", 1)
    rows = _hot_rows()
    dealt, dealing = blocks.deal(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), batch_bytes)
    held = {}
    for r in dealt.collect():
        held.setdefault(r["batch"], []).append((r["id"], len(r["text"])))
    assert sum(map(len, held.values())) == len(rows) and max(held) < len(dealing)
    longest = max(len(t) for _, t in rows)
    assert sorted(sum(n for _, n in b) for b in held.values())[-2] <= 2 * batch_bytes + 1_000
    assert max(sum(n for _, n in b) for b in held.values()) <= longest + 2 * batch_bytes
    # Cells ascend with ids, and only batches of one id share a cell.
    cells = {}
    for b in sorted(held):
        cells.setdefault(int(dealing.cells(np.array([b]))[0]), []).append({i for i, _ in held[b]})
    assert all(len(c) == 1 or len(set.union(*c)) == 1 for c in cells.values())
    spans = [(min(set.union(*cells[c])), max(set.union(*cells[c]))) for c in sorted(cells)]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_borders_at_the_ends_of_the_numbers():
    least, most = -2**63, 2**63 - 1
    dealing = blocks.Dealing(np.array([least, least, 4, 9, 9, 9, most, most]))
    ids = np.array([least, least + 1, 4, 5, 8, 9, 10, most - 1, most])
    cells = dealing.cells(dealing.batches(ids, np.arange(len(ids))))
    assert cells.tolist() == [0, 1, 1, 2, 2, 3, 4, 4, 5] and len(blocks.Dealing(np.zeros(0))) == 1


def test_suffix_array_with_a_gram_in_very_many_runs(spark, monkeypatch):
    rng = random.Random(6)
    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz é") for _ in range(n))
    phrases = [noise(90) for _ in range(3)]
    rows = [(i, noise(60) + p[:rng.randint(30, 90)] + noise(60) + p[rng.randint(0, 40):] + noise(9)) for i in range(150, 0, -1) for p in [rng.choice(phrases)]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    expected = brute.byte_strings(rows)
    assert sum(v[1] for v in expected.values()) > 1000
    assert by_id(suffix_array.remove_repeated_strings(docs)) == expected
    for a_batch, a_gram in ((1, 4096), (128, 2), (2, 5), (0, 0)):
        monkeypatch.setattr(suffix_array, "RUNS_A_BATCH", a_batch)
        monkeypatch.setattr(suffix_array, "RUNS", a_gram)
        assert by_id(suffix_array.remove_repeated_strings(docs)) == expected


def test_a_batch_sends_no_more_runs_of_a_gram_than_its_limit():
    rng = random.Random(7)
    phrase = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = ["".join(rng.choice("ijklmnop") for _ in range(60)) + phrase + str(i) * 20 for i in range(10**5, 10**5 + 500)]
    table = pa.table({"id": pa.array(range(500), pa.int64()), "text": pa.array(texts)})
    batch = suffix_array._Batch(table, 50, 128)
    distinct, sent = (np.unique(k, return_counts=True)[1].max() for k in (batch.keys, batch.run_keys()[::2]))
    assert distinct > 128 >= sent


def test_deep_shallow_sorts_and_marks_equal_rows():
    rows = np.random.default_rng(1).integers(0, 3, (900, 50)).astype(np.uint8)
    rows[300:600] = rows[:300]
    rows[600:700, :45] = rows[:100, :45]
    order, head = suffix_array.deep_shallow(rows)
    expected = sorted(map(bytes, rows))
    assert [bytes(r) for r in rows[order]] == expected
    assert head.tolist() == [True] + [a != b for a, b in zip(expected, expected[1:])]


def test_near_duplicates(documents, pairs, odd, odd_rows):
    assert by_id(near_duplicates(documents, 4)) == brute.near(pairs)
    assert by_id(near_duplicates(odd, 4)) == brute.near(odd_rows)


def test_near_duplicates_in_one_large_group(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(rng.choice([1, 3, 5, 6, 8])):
            words[rng.randrange(100)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    assert by_id(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)) == brute.near(rows)


def test_packs_are_bounded_however_large_a_group_or_a_set(spark, monkeypatch):
    sketch = [F.lit(0).cast("bigint").alias(name) for name in minhash._SKETCH]
    members = spark.range(3000).select(F.lit(7).alias("cluster"), "id", F.col("id").alias("component"), F.lit(40).cast("bigint").alias("n"),
                                       *sketch, F.lit(b"").alias("keys"))
    monkeypatch.setattr(minhash, "BLOCK", 64)
    monkeypatch.setattr(minhash, "PACK", 512)
    for rows, largest in ((members, 2048), (members.where("id < 300").withColumn("n", F.lit(512 * 9).cast("bigint")), 205)):
        packs = minhash._packed(rows, ["cluster"], True).groupBy("pack").count()
        assert packs.agg(F.max("count")).first()[0] <= largest
        assert minhash._block_links(rows, ["cluster"], 80, False).count() > 0


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)]
    parent = {x: x for link in links for x in link}
    for _ in range(50):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {x: c for x, c in parent.items() if x in found} and all(parent[x] == x for x in parent if x not in found)


def test_benchmark_windows(documents, pairs, odd, odd_rows, items, spark, folder):
    own = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert by_id(find_benchmark_windows(documents, own)) == brute.benchmark(pairs, [tuple(r) for r in own.select("item_id", "text").collect()])
    found, expected = by_id(find_benchmark_windows(odd, items)), brute.benchmark(odd_rows, [tuple(r) for r in items.collect()])
    # An item without an id hits words but isn't counted.
    assert {i: (v[0], v[1], v[4]) for i, v in found.items()} == {i: (v[0], v[1], v[4]) for i, v in expected.items()}
    assert found[71][2] == 1 and found[91][2] == 1 and by_id(find_benchmark_windows(odd, items.limit(0)))[71][1] == 0


def test_simhash(documents, pairs, odd, odd_rows):
    assert by_id(edited_neighbours(documents)) == brute.edited(pairs)
    assert by_id(edited_neighbours(odd)) == brute.edited(odd_rows)


def test_radius_search_finds_all(spark):
    rng = random.Random(4)
    prints = [rng.getrandbits(64) for _ in range(40)]
    prints += [p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for p in prints for _ in range(5)]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    found = {r[0]: r[1] for r in within_radius(df, df, 3).collect()}
    assert found == {s: sum((p ^ q).bit_count() <= 3 for q in prints) for s, p in zip(signed, prints)}
    assert df.select(distance(F.lit(0), F.lit(-1))).first()[0] == 64


def test_bpe_is_the_library(documents, odd, spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    letters = [*"ab c  \n\t\r 12'sré漢𝔸½_<|>\u0085\x1c​", "<|endoftext|>", "'ll", " the "]
    rows = [(10**6 + k, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for k in range(400)]
    rows += [(5, "abcdefgh" * 3000), (6, "\0a \0")]
    for docs in (documents.select("doc_id", "text"), odd.select("doc_id", "text"), spark.createDataFrame(rows, "doc_id bigint, text string")):
        expected = {}
        for i, text in docs.collect():
            ids = library.encode(text or "", add_special_tokens=False).ids
            expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(library.decode(ids, skip_special_tokens=False)))
        assert by_id(encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))) == expected


def test_transducer_numbers_words_and_shares_ends():
    words = sorted({w.encode() for w in ["tap", "taps", "top", "tops", "tip", "tips", "a", "ab", "é"]})
    made = Transducer(Transducer.compile(words, lambda w: [len(w)] * 2))
    assert made.numbers(words).tolist() == list(range(len(words)))
    assert made.numbers([b"t", b"tapss", b"", b"x"]).tolist() == [-1] * 4
    assert len(made.final) < sum(map(len, words)) and made.ids.tolist() == [len(w) for w in words for _ in range(2)]
    none = Transducer(Transducer.compile([], lambda w: []))
    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    assert none.numbers([b"a"]).tolist() == [-1]
    assert Encoder(vocabulary, none).encode(["hello"])[0].tolist() == vocabulary.merge(b"hello")


def test_language_model(documents, pairs, odd, odd_rows):
    for docs, rows in ((documents, pairs), (odd, odd_rows)):
        expected = brute.unigrams(rows)
        for r in score_texts(docs).collect():
            held, n, known, total, base = expected[r["doc_id"]]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    better = score_texts(documents).where("held_out").agg(F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()[0]
    assert better > 0.8


def test_language_of_held_out_documents(spark, folder, documents, odd):
    rows = identify_language(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    found = by_id(identify_language(odd))
    assert len(found) == odd.count()
    assert all(found[i][1:] == ("und", 0.0) for i in (1, 11, 21, 151)) and all(0 <= v[2] <= 1 for v in found.values())


def test_a_corpus_without_labels_keeps_its_texts_with_letters(spark):
    rows = [(1, "Hello", None), (2, None, None), (3, "12 !", None), (4, "漢字", None), (None, "x", None), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(r["text"] for r in keep_identified(docs).collect()) == ["Hello", "x", "漢字"]
    assert {r["lang_pred"] for r in identify_language(docs).collect()} == {"und"}


def test_numbers_are_no_letters_and_a_learnt_language_may_be_called_und(spark):
    texts = ["½ ²", "①", "Ⅷ 12", "ª", "ß", "x½", "漢", "_", ""]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, f"wort{i} und", "und") for i in range(40)] + [(200 + i, f"the word{i}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = by_id(identify_language(docs))
    assert [got[i][2] > 0 for i in range(9)] == [False, False, False, True, True, True, True, False, False]
    assert all(got[i][1] == "und" for i in (0, 1, 2, 7, 8))
    kept = {r["doc_id"] for r in keep_identified(docs).collect()}
    assert kept == {3, 4, 5, 6, *range(100, 140), *range(200, 240)} and any(got[i][1] == "und" for i in range(100, 140))


def test_a_sample_is_bounded_whatever_the_ids(spark):
    rows = [(5, "same", "en")] * 3000 + [(5, f"text {k}", "en") for k in range(3000)] + [(k, f"das {k}", "de") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    sample, counts = language_id.sampled_by_label(docs, "lang", 300, ("doc_id", "text"))
    taken = {r[0]: r[1] for r in sample.groupBy("lang").count().collect()}
    assert counts == {"en": 6000, "de": 3000} and 100 < taken["en"] < 220 and 230 < taken["de"] < 370
    held = language_id.within_bytes(sample, "lang", 1_500).groupBy("lang").agg(F.sum(F.octet_length("text"))).collect()
    assert len(held) == 2 and all(0 < r[1] <= 500 for r in held)


def test_remembered_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "_REMEMBERED_BYTES", 5_000)
    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = Encoder(vocabulary, Transducer(Transducer.compile([], lambda w: [])))
    for k in range(30):
        text = f"{k}abc" * 300 + " é  end"
        assert encoder.decode(encoder.encode([text])[0]).decode() == text
        assert encoder.chunks.held + encoder.held < 5_000 + 6 * len(text)


def test_gradient_of_the_recurrent_network():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in _new_network(3, 1).items()}
    x, label = rng.integers(0, 256, (6, 5)), rng.integers(0, 3, 6)

    def loss():
        p = label_positions(net, x)
        return -np.log(p[:, np.arange(6), label]).mean()

    gradient = _gradient(net, x, label)
    for name in net:
        at = tuple(np.array(net[name].shape) // 2)
        if name.endswith("_in"):
            at = (x[2, 2], 5)
        old = net[name][at]
        net[name][at] = old + 1e-3
        up = loss()
        net[name][at] = old - 1e-3
        slope = (up - loss()) / 2e-3
        net[name][at] = old
        assert gradient[name][at] == pytest.approx(slope, abs=2e-3)


def test_quality_of_held_out_documents(spark, folder, documents, odd, labels):
    known = spark.read.parquet(f"{folder}/labels.parquet")
    rows = score_quality(documents, known).join(known, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.8
    found = score_quality(odd, labels)
    assert found.count() == odd.count() and found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert by_id(score_quality(odd, labels.limit(0)))[1][1] == 0.5


def test_simhash_links_are_all_pairs_within_the_radius(spark, documents):
    base = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").orderBy("doc_id").limit(300).collect()]
    copies = [(10_000 + i, (t or "") + " tail") for i, t in base[:100]] + [(None, base[0][1]), (None, None), (50_000, base[0][1]), (50_000, base[0][1])]
    docs = spark.createDataFrame(base + copies, "doc_id bigint, text string")
    prints = [(r["doc_id"], int(r["fingerprint"], 16), r["n_near"]) for r in edited_neighbours(docs).collect()]
    asked = {f for i, f, _ in prints if i is not None and i % 50 == 0}
    count = {}
    for _, f, _ in prints:
        count[f] = count.get(f, 0) + 1
    want = {(f, g): ((f ^ g).bit_count(), n) for f in asked for g, n in count.items() if f != g and (f ^ g).bit_count() <= 3}
    got = {(int(r["fingerprint"], 16), int(r["other"], 16)): (r["n_bits"], r["n_other"]) for r in document_links(docs).collect()}
    assert got == want and want
    for i, f, near in prints:
        if i is not None and i % 50 == 0:
            assert near == count[f] - 1 + sum(n for (a, _), (_, n) in want.items() if a == f)


def test_chat_snapshots_collapse(spark):
    turns = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"),
             (4, 0, "user", "h"), (4, 1, "bot", None), (5, None, None, ""), (None, 0, "user", "x")]
    rows = by_id(format_conversations(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")))
    assert rows == {2: (2, 2, "<|user|>\nhi<|end|>\n<|bot|>\nyo<|end|>"), 4: (2, 1, "<|user|>\nh<|end|>\n<|bot|>\n<|end|>"), 5: (1, 1, "<||>\n<|end|>")}


def test_a_conversation_with_most_of_the_turns_collapses_its_snapshots(spark):
    n = 30_000
    turns = spark.range(n).select(F.lit(9).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"),
                                  F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("text"))
    log = (turns.union(turns.where(f"turn < {n - 1}").withColumn("conv_id", F.lit(1).cast("bigint")))
           .union(turns.withColumn("conv_id", F.lit(4).cast("bigint")))
           .union(turns.where("turn < 2").withColumns({"conv_id": F.lit(2).cast("bigint"), "turn": 1 - F.col("turn")})))
    rows = by_id(format_conversations(log.repartition(6)))
    assert {k: r[:2] for k, r in rows.items()} == {4: (n, 2), 2: (2, 1)}
    assert rows[4][2] == "\n".join(f"<|u|>\nt{i % 7}<|end|>" for i in range(n))
    assert rows[2][2] == "<|u|>\nt1<|end|>\n<|u|>\nt0<|end|>"


def test_chat_is_the_sql(spark, folder):
    import checker
    connection = checker.duck(folder)
    for name, sql in queries.ORACLES.items():
        assert checker.compare(spark, connection, folder, queries.QUERIES[name], sql) is None


def test_empty_tables(spark, empty, labels, items):
    results = [remove_repeated_windows(empty), suffix_array.remove_repeated_strings(empty), near_duplicates(empty), edited_neighbours(empty),
               find_benchmark_windows(empty, items), encode_documents(empty, public_tokenizers.path("byte_bpe_50k.json")), score_texts(empty),
               identify_language(empty), score_quality(empty, labels),
               format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))]
    assert [r.count() for r in results] == [0] * len(results)


def test_repeated_rows_and_missing_ids(spark, items):
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, "other words here")], "doc_id bigint, text string")
    def pairs_of(df, column):
        return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r[column]) for r in df.collect()))
    for removed in (remove_repeated_windows(docs), suffix_array.remove_repeated_strings(docs)):
        whole = 40 if "n_words" in removed.columns else len(text)
        assert pairs_of(removed, "n_removed") == [(False, 1, 0), (False, 1, 0), (False, 2, whole), (True, 0, 0), (True, 0, whole)]
    assert pairs_of(near_duplicates(docs), "kept") == [(False, 1, True), (False, 1, True), (False, 2, False), (True, 0, True), (True, 0, True)]
    for rows in (edited_neighbours(docs), score_texts(docs), find_benchmark_windows(docs, items), identify_language(docs.withColumn("lang", F.lit("en"))),
                 encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))):
        assert pairs_of(rows, rows.columns[1]) and rows.count() == 5


def test_pipeline_stages(spark, folder, documents, tmp_path):
    docs = documents
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, before, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.dtypes == before.dtypes
        if k == 1:
            near = brute.near([tuple(r) for r in before.select("doc_id", "text").collect()], 5)
            assert {r[0] for r in docs.select("doc_id").collect()} == {i for i, v in near.items() if v[2]}
        if k == 2:
            cut = {r["doc_id"]: r["n_removed"] for r in suffix_array.remove_repeated_strings(before).collect()}
            old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, docs))
            assert all(new[i] == old[i] for i in new if not cut[i]) and all(len(new[i]) < len(old[i]) for i in new if cut[i])
            assert docs.where("n_chars <> char_length(text)").count() == 0 and all(cut[i] for i in old.keys() - new.keys())
        if k == 3:
            own = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
            hit = brute.benchmark([tuple(r) for r in before.select("doc_id", "text").collect()], own)
            assert {r[0] for r in docs.select("doc_id").collect()} == {i for i, v in hit.items() if not v[4]}
    assert docs.count() == before.count() and {"n_tokens", "ids", "ids_sha256", "decoded_sha256"} <= set(docs.columns)
    odd = spark.createDataFrame([(1, None, "en", "s", 0), (2, "Hello the world", None, None, None), (3, "12 34", "en", "s", 5)],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # Columns with names that the operators use themselves, and with dots, go through all stages.
    clashing = odd
    for name in ("gone_id", "a.b", "carry", "id", "batch", "row", "weight", "cell", "kept", "text_hash", "held"):
        clashing = clashing.withColumn(name, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, clashing, folder)
        assert after.columns == clashing.columns and after.count() == (1 if name == "language_id" else 3), name
    assert corpus_pipeline.STAGES[4][1](spark, clashing, folder).count() == 3
    assert corpus_pipeline.STAGES[2][1](spark, odd, folder).count() == 3 and corpus_pipeline.STAGES[3][1](spark, odd, folder).count() == 3


def test_maxent_counts_rare_words_too(monkeypatch):
    monkeypatch.setattr(maxent, "WORDS_HELD", 8)
    texts = pa.array([f"w{i} w{i + 1} common" for i in range(40)])
    batch = pa.RecordBatch.from_arrays([texts, pa.array([True] * 39 + [False])], ["text", "learnt"])
    found = pa.Table.from_batches(list(maxent._word_counts([batch, batch]))).to_pandas().groupby("key")["n"].sum()
    # Forty words of the texts to learn from, and the common one; the last text is left out.
    assert sorted(found.tolist()) == [2, 2] + [4] * 38 + [78]


def test_probabilities_do_not_depend_on_the_shift_of_scores():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 50, (5, 200)).astype(np.uint16)
    for spread in (1, 40):  # one shift for all tokens, and one for each
        weights = rng.normal(0, spread, (50, 16)).astype(np.float32)
        scores = weights[rows].sum(axis=0).astype(float)
        want = np.exp(scores - scores.max(axis=1, keepdims=True))
        made, total = maxent._exponentials(weights, rows)
        np.testing.assert_allclose(made / total[:, None], want / want.sum(axis=1, keepdims=True), rtol=2e-3, atol=1e-30)


def test_a_gradient_step_adds_up_the_rows_of_repeated_features():
    rng = np.random.default_rng(4)
    rows = np.concatenate([np.zeros((1, 300), int), rng.integers(1, 40, (3, 300))]).astype(np.uint16)
    target, weights = rng.integers(0, 16, 300), rng.normal(size=(40, 16)).astype(np.float32)
    scores = np.exp(weights[rows].sum(axis=0).astype(float))
    d = scores / scores.sum(axis=1, keepdims=True) - np.eye(16)[target]
    want, squares = weights.astype(float), np.zeros((40, 16))
    for own in rows:
        g = np.zeros((40, 16))
        np.add.at(g, own, d)
        squares += g * g
        want -= maxent.RATE * g / np.sqrt(squares + 1)
    maxent._step(weights, np.zeros((40, 16), np.float32), rows, target)
    np.testing.assert_allclose(weights, want, atol=1e-4)


def test_components_let_go_of_the_shuffles_of_earlier_steps(spark):
    cleaned = []

    def files():
        place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(1 for b in place.getAllFiles().mkString("\n").split("\n") if b.endswith(".index"))

    before = files()
    found = components(spark.range(60).selectExpr("id a", "id + 1 b").repartition(7))
    for _ in range(20):
        cleaned.append(files() - before)
        if cleaned[-1] <= 60:
            break
        time.sleep(0.5)
    assert found.agg(F.max("component"), F.count("*")).first() == (0, 61)
    # A step has about thirty such files, and there are about eight steps.
    assert min(cleaned) <= 60


def test_maxent_model_grows_with_the_words_and_adds_up_to_one():
    assert [maxent._sizes(n)[0] for n in (10, 10**4, 10**5, 10**6, 10**9)] == [1, 2, 2, 3, 5]
    assert maxent._sizes(10**6)[1] > maxent._sizes(10**4)[1]
    rng = np.random.default_rng(6)
    model = maxent.new_model(rng.integers(1, 90, maxent.SYMBOLS), rng.integers(0, 9, (1, 256, maxent.BRANCH)))
    model = {k: v + rng.normal(0, 0.5, v.shape).astype(np.float32) for k, v in model.items()}
    # All that may follow two words: every head, and every branch of every tail.
    symbols = np.concatenate([np.arange(maxent.END + 1), np.repeat(np.arange(maxent.END + 1, maxent.SYMBOLS), maxent.BRANCH)])
    codes = np.concatenate([np.zeros(maxent.END + 1, int), np.tile(np.arange(maxent.BRANCH) << 16, maxent.TAILS)])
    n, one = len(symbols), np.ones(len(symbols), int)
    texts = [np.column_stack([a * one, b * one, c]).ravel() for a, b, c in ((400, 7, symbols), (3 << 16, 0, codes))]
    logs = maxent.log_probabilities(model, *texts, np.zeros(3 * n, bool), np.arange(n + 1) * 3)[2::3]
    assert (10.0 ** logs).sum() == pytest.approx(1, abs=1e-3)


def test_a_rare_word_is_expected_after_the_word_that_it_follows(spark):
    """Of 1,200 words most have no symbol of their own; they are told from the others of their tail by the word before."""
    texts = [f"lead{i % 600} rare{i % 600}xy" for i in range(18_000)] + [f"lead{i} rare{(i + 7) % 600}xy" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    score = {r["doc_id"]: r["score"] for r in score_texts(docs).collect()}
    followed, other = np.mean([score[i] for i in range(600)]), np.mean([score[i] for i in range(18_000, 18_600)])
    assert followed > other + 1.3
