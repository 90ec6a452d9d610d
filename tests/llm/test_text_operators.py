"""Operators on whole texts against brute force, with nulls, empty texts, ties, empty tables and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fathom.llm import audio, common, decontaminate, language_id, ngram_lm, simhash, token_counts
from fathom.llm.elias_fano import EliasFano

DOCS = "doc_id long, text string, fingerprint int, component_id int, n_bytes int, score int, id int, words int"
CLASH = (1, 2, 3, 4, 5, 6)


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, *CLASH) for i, t in zip(ids, texts, strict=True)], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- SimHash -----------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = list(range(len(fps)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 3:
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choices("ab cd ef gh ij kl mn op qr st".split(), k=rng.randint(1, 80))) for _ in range(40)]
    texts = base + [t + " zz" for t in base] + [t.upper() + "\t\n" for t in base[:10]] + [None, "", " \t", "É É É", "one", "one two"]
    want = [brute_fingerprint(t) for t in texts]
    groups = brute_components(want)
    got = by_id(simhash.near_duplicates(docs(spark, texts)))
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{w:016x}" for w in want]
    assert [got[i]["component_id"] for i in range(len(texts))] == groups


@pytest.mark.parametrize("parts", [None, 3, 4, 24])
def test_links_are_all_pairs_within_three_bits(spark, parts):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in set(rng.integers(0, 64, n))) for b in base for n in (0, 1, 2, 3, 4, 5)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {tuple(sorted((signed[i], signed[j]))) for i, j in combinations(range(len(fps)), 2) if bin(fps[i] ^ fps[j]).count("1") <= 3}
    found = [(r["a"], r["b"]) for r in simhash.links(nodes, parts=parts).collect()]
    assert set(found) == want and len(found) == len(want) > 50


def test_keys_outgrow_the_rows():
    assert [simhash.parts_for(n) for n in (0, 1 << 27, 1 << 28, 1 << 33, 1 << 37, 1 << 40)] == [2, 2, 3, 4, 12, 24]


def test_links_of_nameless_rows(spark):
    """Rows without an id reach, and bridge what only they connect."""
    prints = [(9, 0b1), (None, 0b1111), (4, 0b1111111), (None, 0x7FFF << 40), (None, (0x7FFF << 40) | 1)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(simhash, "fingerprints", lambda *_: spark.createDataFrame(prints, "id long, fp long"))
        got = simhash.near_duplicates(docs(spark, ["x"])).collect()
    want = [(i or 0, fp, 4 if fp < 1 << 40 else None) for i, fp in prints]
    assert sorted((r["doc_id"] or 0, int(r["fingerprint"], 16), r["component_id"]) for r in got) == sorted(want)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 199), (200, 198)]
    got = {r["node"]: r["component"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[200] == got[199] == 198


def test_simhash_null_ids_repeats_and_empty(spark):
    got = simhash.near_duplicates(docs(spark, ["x y z", "x y z", "x y z", "q", "w e r t"], [None, 5, 7, None, 5])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 5)]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


# --- token counts ------------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH, token_counts.whole_tokens(PATH)), Tokenizer.from_file(PATH)


pieces = st.lists(st.one_of(st.text(max_size=6), st.sampled_from(["the", "don't", " ", "\x1c", " ", "<|endoftext|>", "<|", "Straße", "ΑΣ", "İ", "😀", "1234", "\x85"])), max_size=12).map("".join)


@given(pieces)
@settings(max_examples=300, deadline=None)
def test_counts_are_the_librarys(counter, text):
    mine, library = counter
    assert mine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_proved(counter):
    mine, library = counter
    assert "the" in mine.whole and all(len(library.model.tokenize(w)) == 1 for w in list(mine.whole)[:500])


def test_token_count_rows(spark, counter):
    texts = ["the cat", None, "", "x" * 5000, "word " * 3000, "the cat"]
    got = by_id(token_counts.token_counts(docs(spark, texts), PATH))
    for i, t in enumerate(texts):
        n = len(counter[1].encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 2048)
    assert token_counts.token_counts(docs(spark, []), PATH).count() == 0
    again = token_counts.token_counts(docs(spark, ["the cat"] * 3, [None, 7, 7]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in again) == [(0, got[0]["n_tokens"]), (7, got[0]["n_tokens"]), (7, got[0]["n_tokens"])]


# --- audio -------------------------------------------------------------------------------------------


def test_audio_round_trip_and_rows(spark):
    texts = ["hello", None, "", "é" * 500, "a" * 192, "b " * 50_000, "hello"]
    got = by_id(audio.audio_features(docs(spark, texts)))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert audio.from_wav(bytes(r["media"])) == payload and hashlib.sha256(r["media"]).hexdigest() == r["media_sha256"] and r["media_bytes"] == len(r["media"])
        t = audio.read_tensors(bytes(r["tensors"]))
        assert isinstance(t.schema.field("log_mel").type, pa.FixedShapeTensorType) and t.column("end_s")[-1].as_py() >= len(payload) / 8000 - 1e-9
    assert got[0]["feature"] == got[6]["feature"] and audio.audio_features(docs(spark, [])).count() == 0
    again = audio.audio_features(docs(spark, ["hello"] * 3, [None, 7, 7])).collect()
    assert sorted((r["doc_id"] or 0, r["feature"]) for r in again) == [(0, got[0]["feature"]), (7, got[0]["feature"]), (7, got[0]["feature"])]


def test_resampling_keeps_constants_and_tones():
    assert audio.resample(np.full(400, 0.3)) == pytest.approx(0.3)
    t = np.arange(1600) / 8000
    got, want = audio.resample(np.sin(2 * np.pi * 500 * t)), np.sin(2 * np.pi * 500 * np.arange(1200) / 6000)
    assert np.abs(got - want)[50:-50].max() < 0.02


def test_log_mel_blocks_agree(monkeypatch):
    x = np.random.default_rng(0).normal(size=9000)
    whole = audio.log_mel(x)
    monkeypatch.setattr(audio, "BLOCK", 7)
    assert np.array_equal(audio.log_mel(x), whole)


def test_hysteresis():
    """The mean is 1.5: 9 opens, 3 keeps open but does not open, 0 closes. One threshold would give (6, 7), or three stretches."""
    level = np.array([0, 3, 0, 0, 0, 0, 9, 3, 3, 0, 0, 0, 3, 0], float)
    mel = np.repeat((level / 10)[:, None], audio.MELS, axis=1).astype(np.float32)
    assert audio.segments(mel) == [(6, 9)]


def test_resampling_blocks_agree(monkeypatch):
    x = np.random.default_rng(1).normal(size=5001)
    whole = audio.resample(x)
    monkeypatch.setattr(audio, "BLOCK", 7)
    assert np.allclose(audio.resample(x), whole, rtol=0, atol=1e-12) and len(whole) == 5001 * 3 // 4


def test_log_mel_is_that_of_a_direct_transform():
    x = np.random.default_rng(2).normal(size=audio.FRAME + 2 * audio.HOP)
    k, t = np.arange(audio.FFT // 2 + 1)[:, None], np.arange(audio.FRAME)
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * (t + 1) / (audio.FRAME + 1))
    for frame, got in enumerate(audio.log_mel(x)):
        part = x[frame * audio.HOP : frame * audio.HOP + audio.FRAME] * hann
        power = np.abs((part * np.exp(-2j * np.pi * k * t / audio.FFT)).sum(1)) ** 2
        assert got == pytest.approx(np.log10(power @ audio.mel_bank() + audio.FLOOR), abs=1e-4)


# --- language ID -------------------------------------------------------------------------------------

WORDS = {"aa": "lama kora nami tolu", "bb": "striz krupf schwelz brint", "cc": "été çare ñoûl èsse"}


def sample(n=60):
    rng = random.Random(3)
    return [(i, " ".join(rng.choices(WORDS[lang].split(), k=20)), lang) for i, lang in enumerate(sorted(WORDS) * n)]


def test_language_id_learns_and_rejects(spark):
    labelled = spark.createDataFrame([*sample(), (9001, None, "aa"), (9002, "lama", None)], "doc_id long, text string, lang string")
    model = language_id.train(labelled)
    test = spark.createDataFrame([(1, "kora nami lama", 0, "x"), (2, "krupf striz brint", 0, "x"), (3, "çare été", 0, "x"), (4, None, 0, "x"), (5, "", 0, "x"), (6, "123 !? _", 0, "x"), (7, "lama " * 300_000, 0, "x"), (None, "striz", 0, "x")], "doc_id long, text string, lang_pred int, c0 string")
    got = {r["doc_id"]: r for r in language_id.identify(test, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, 7, None)] == ["aa", "bb", "cc", "und", "und", "und", "aa", "bb"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["accepted"] and not got[4]["accepted"]
    assert language_id.identify(test.limit(0), model).count() == 0
    again = language_id.train(labelled.repartition(5))
    assert np.array_equal(again.table, model.table) and again.threshold == model.threshold


def brute_language(model, text):
    """(language, probability) from the definition: every n-gram of the cleaned text, one at a time."""
    cleaned = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    cleaned = f" {' '.join(cleaned.split())} ".encode()
    if not cleaned.strip():
        return "und", 0.0
    total, n = np.zeros(len(model.names)), 0
    for size in range(1, 5):
        for i in range(len(cleaned) - size + 1):
            h = 0
            for k, byte in enumerate(cleaned[i : i + size], 1):
                h = ((h * 0x01000193) & 0xFFFFFFFF) ^ (byte + (k << 8))
            total, n = total + model.table[(h * 0x9E3779B1 & 0xFFFFFFFF) >> 19], n + 1
    z = (total / n + model.bias) / model.temperature
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return model.names[int(p.argmax())], float(p.max())


def test_language_id_equals_brute_force(spark, monkeypatch):
    model = language_id.train(spark.createDataFrame(sample(), "doc_id long, text string, lang string"))
    texts = ["kora nami", "krupf striz 12 lama", "çare, été!", "x", "", None, "...", "lama çare " * 40]
    for block in (language_id.BLOCK, 5, 64):  # n-grams over the edges of blocks count
        monkeypatch.setattr(language_id, "BLOCK", block)
        for t in texts:
            lang, p, _ = model.predict(t)
            want = brute_language(model, t)
            assert lang == want[0] and p == pytest.approx(want[1], abs=1e-9)


def test_language_id_held_out_accuracy(spark):
    """Languages of the documents that training does not see, and probabilities that mean what they say."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from fathom.llm import queries

    judged = queries.op8_language_id(spark, "/root/testdata/sf0.01").where("held_out").withColumnRenamed("doc_id", "d")
    rows = judged.join(docs, F.col("d") == F.col("doc_id")).where("lang IS NOT NULL AND lang_pred <> 'und'").select("lang", "lang_pred", "score").collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert len(rows) > 100 and np.mean(right) >= 0.97
    assert abs(np.mean(right) - np.mean([r["score"] for r in rows])) < 0.05


def test_language_id_repeats(spark):
    model = language_id.train(spark.createDataFrame(sample(), "doc_id long, text string, lang string"))
    rows = language_id.identify(docs(spark, ["kora nami"] * 3 + ["striz"], [1, 1, None, 1]), model).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in rows) == [(0, "aa"), (1, "aa"), (1, "aa"), (1, "bb")]


def test_language_id_without_labels(spark):
    model = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert model.predict("lama") == ("und", 0.0, False)


# --- n-gram model ------------------------------------------------------------------------------------


@given(st.lists(st.integers(0, (1 << 50) - 1), max_size=200), st.lists(st.integers(0, 1 << 50), max_size=50))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, keys):
    v = np.sort(np.array(values, np.uint64))
    ef = EliasFano.of(v, 1 << 50)
    assert np.array_equal(ef.access(np.arange(len(v))), v)
    q = np.concatenate([np.array(keys, np.uint64), v])
    want = [int(np.searchsorted(v, k)) if k in set(values) else -1 for k in q.tolist()]
    assert ef.find(q).tolist() == want
    # Between pointers: only what lies in each key's own range is found.
    first, end = np.arange(len(q)) % (len(v) + 1), np.minimum(len(v), np.arange(len(q)) % (len(v) + 1) + 3)
    near = [next((i for i in range(a, b) if int(v[i]) == k), -1) for k, a, b in zip(q.tolist(), first.tolist(), end.tolist(), strict=True)]
    assert ef.find(q, first, end).tolist() == near


def brute_tokens(text):
    return (text or "").encode().lower().split()


def test_words_of_texts():
    texts = ["A b\tC", "", None, "x", "  y z ", "É ü", "ab", "ba", "x"]
    hashes, counts = ngram_lm.words_of(*ngram_lm.buffers(pa.array(texts)))
    words = [w for t in texts for w in brute_tokens(t)]
    assert counts.tolist() == [len(brute_tokens(t)) for t in texts] and len(hashes) == len(words)
    names = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def brute_model(train, order=2):
    """(counts, counts of each order) and a scorer without quantising."""
    uni, grams = Counter(), Counter()

    def padded(t):
        return ["<s>"] * (order - 1) + [*brute_tokens(t), "</s>"]

    for t in train:
        w = padded(t)
        uni.update(w[order - 1 :])
        for k in range(2, order + 1):
            grams.update(tuple(w[i - k + 1 : i + 1]) for i in range(order - 1, len(w)))
    total = sum(uni.values())
    kinds = len(uni)
    per = {}
    for g, c in grams.items():
        per.setdefault(g[:-1], []).append(c)
    ones, twos = sum(c == 1 for c in uni.values()), sum(c == 2 for c in uni.values())
    d1 = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))

    def score(text):
        w = padded(text)
        base = out = known = 0
        for i in range(order - 1, len(w)):
            x = w[i]
            p = (uni[x] - d1) / total if uni[x] else d1 * kinds / total
            for k in range(2, order + 1):
                g = tuple(w[i - k + 1 : i + 1])
                if g[:-1] in per:
                    cs = per[g[:-1]]
                    d = (cs.count(1) + 1) / (cs.count(1) + 2 * cs.count(2) + 1)
                    p = d * len(cs) / sum(cs) * p + (max(grams[g] - d, 0) / sum(cs) if g in grams else 0.0)
            out += math.log10(min(1, p))
            base += math.log10((uni[x] + 0.1) / (total + 0.1 * (kinds + 1)))
            known += uni[x] > 0
        return len(w) - order + 1, known, total, base, out

    return score


@pytest.mark.parametrize(("shard_bytes", "order"), [(1 << 20, 2), (300, 2), (2000, 3), (1 << 20, 4)])
def test_ngram_model_equals_brute_force(spark, shard_bytes, order):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=rng.randint(0, 60))) for _ in range(80)] + [None, "W1 w2\nnever seen"]
    df = docs(spark, texts)
    model = ngram_lm.learn(df.where("doc_id < 60"), shard_bytes=shard_bytes, order=order)
    want = brute_model(texts[:60], order)
    got = by_id(ngram_lm.score(df, model))
    for i, t in enumerate(texts):
        n, known, total, base, out = want(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(out, abs=0.035 * n)


def test_a_common_context_is_spread(spark):
    rng = random.Random(6)
    texts = [" ".join(f"the w{rng.randrange(3000)}" for _ in range(50)) for _ in range(60)]
    model = ngram_lm.learn(docs(spark, texts), shard_bytes=4000)
    the = ngram_lm.words_of(*ngram_lm.buffers(pa.array(["the"])))[0]
    held = [int(model.level(p).followers(the)[0]) for p in model.pairs[0]]
    assert len(held) > 5 and min(held) > 0 and sum(held) == len({w for t in texts for w in t.split()} - {"the"})


def test_successors_are_searched_between_pointers(spark):
    """Without the pointers no pair is found, and few bytes mapped at a time change nothing."""
    model = ngram_lm.learn(docs(spark, ["a b c a b d", "a b"] * 5), shard_bytes=20)
    h, n = ngram_lm.words_of(*ngram_lm.buffers(pa.array(["a b c"])))
    before = model.score(h, n)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_lm, "MAPPED", 1)
        assert all(np.array_equal(x, y) for x, y in zip(model.score(h, n), before, strict=True)) and len(model.maps) == 1
    model.maps.clear()
    level = ngram_lm.Level.__init__

    def without(self, path):
        level(self, path)
        self.ef.pop("starts", None)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_lm.Level, "__init__", without)
        with pytest.raises(KeyError):
            model.score(h, n)


def test_ngram_scores_of_nameless_and_repeated_rows(spark):
    model = ngram_lm.learn(docs(spark, ["a b", "a b", None]))
    rows = ngram_lm.score(docs(spark, ["a b", "a b", "a b", "long " * 100_000], [None, 3, 3, 4]), model).collect()
    assert len({r["score"] for r in rows if r["doc_id"] != 4}) == 1 and sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 3), (3, 3), (3, 3), (4, 100_001)]


def test_ngram_model_of_nothing(spark):
    model = ngram_lm.learn(docs(spark, []))
    r = ngram_lm.score(docs(spark, ["a b"]), model).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert ngram_lm.score(docs(spark, []), model).count() == 0


def test_blocks_are_lossless():
    a, b = np.array([3, 3, 9, 9, 9], np.uint64), np.array([1, 1 << 50, 7, 7, 2], np.uint64)
    names, following, counts = ngram_lm.counted(a, b)
    first = np.array([0, 2])
    c, runs, f, n = ngram_lm.from_block(ngram_lm.to_block(names[first], np.array([2, 2]), following, counts))
    assert c.tolist() == [3, 9] and runs.tolist() == [2, 2] and f.tolist() == [0, 1 << 34, 0, 0][:0] + following.tolist() and n.tolist() == counts.tolist()


# --- decontamination ---------------------------------------------------------------------------------


def brute_words(text):
    import re

    lowered = (text or "").translate(str.maketrans(common.UPPER, common.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_contamination(text, items):
    words, inside, found = brute_words(text), set(), set()
    for ident, item in items:
        w = brute_words(item)
        m = min(len(w), 10)
        windows = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in windows:
                inside.update(range(i, i + m))
                found.add(str(ident))
    return len(words), len(inside), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = "a b c d é Ü 1".split()
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([12, 15, 30, 10, 9, 3, 25, 11])] + [(20, None), (21, "...")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(40)]
    for i in range(15):
        words = items[rng.randrange(7)][1].split()
        cut = rng.randint(0, max(0, len(words) - 10))
        texts.append("x-" + "; ".join(words[cut : cut + rng.randint(8, 14)]).upper().replace("É", "é") + " " + texts[i])
    texts += [None, "", "...", texts[45], "long " * 60_000 + items[2][1]]
    table = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, fp int")
    got = by_id(decontaminate.decontaminate(docs(spark, texts), table))
    hit = 0
    for i, t in enumerate(texts):
        n, inside, found, sha = brute_contamination(t, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, inside, found, sha, inside > 0)
        assert sum(s["end"] - s["pos"] for s in r["spans"] or []) == inside
        hit += inside > 0
    assert 10 < hit < len(texts)


def test_decontamination_empty_and_repeated(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark, []), items).count() == 0
    clean = decontaminate.decontaminate(docs(spark, ["a b c"]), items.limit(0)).first()
    assert (clean["n_hit"], clean["contaminated"], clean["n_words"]) == (0, False, 3)
    got = decontaminate.decontaminate(docs(spark, ["x a b c", "x a b c", "none", "a b c"], [None, None, 4, 4]), items)
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in got.collect()) == [(0, 3), (0, 3), (4, 0), (4, 3)]


def test_ascii_lower(spark):
    text = "AZ az ÀÉ İK"
    df = spark.createDataFrame([(text,), ("PLAIN",), (None,)], "t string")
    assert [r[0] for r in df.select(common.ascii_lower(F.col("t"))).collect()] == [text.replace("AZ", "az"), "plain", None]
