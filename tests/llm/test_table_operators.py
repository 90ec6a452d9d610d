"""URL filters, curriculum, chats, archives and the pipeline against plain versions."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from fathom.llm import chat, curriculum, queries, url_filter, warc

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("net", "/fr/", "allow")]


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([i for i in (path.find(c) for c in "?#") if i >= 0] or [len(path)])]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_verdicts_of_repeats_and_long_urls(spark):
    long = "http://" + "a." * 2000 + "example.com/en/" + "x" * 100_000
    pages = spark.createDataFrame([(1, "http://net/es/"), (1, "http://net/es/"), (1, "http://b.com/"), (2, long)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert sorted((r["page_id"], r["verdict"], r["rule"]) for r in url_filter.judge(pages, rules).collect()) == [(1, "allow", "com/"), (1, "block", "net/es/"), (1, "block", "net/es/"), (2, "block", "example.com/en/")]


def test_chats_order_ties_by_role_and_text(spark):
    rows = [(1, 0, "b", "x"), (1, 0, "a", "z"), (1, 0, "a", "y"), (2, 0, "a", "y"), (2, 0, "a", "z"), (3, 5, "u", "long " * 200_000), (3, 5, "u", "long " * 200_000), (4, None, "u", "n"), (4, 0, "u", "m")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert sorted(got) == [1, 3, 4] and got[3]["n_turns"] == 2
    assert got[1]["rendered"] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in (("a", "y"), ("a", "z"), ("b", "x")))
    assert got[4]["rendered"].index("\nn<") < got[4]["rendered"].index("\nm<")


def test_url_verdicts(spark):
    urls = ["http://A.Example.COM/en/x?q#f", "https://www.example.com/en/1", "http://x.net/fr/", "http://net/es/1", "http://example.com", "http://examplecom/en/", "http://a.com?x=/en/", "ftp://u:p@b.com:80/en/#", "no scheme", "", None, "http://", "http:///en/", "http://É.com/", "http://notexample.com/en/", "http://x.net/f", "http://x.net/fr/"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)] + [(None, urls[0], "x", "y")], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert len(got) == len(urls) + 1
    for i, u in enumerate(urls):
        assert got[i] == brute_verdict(u, RULES), u
    assert got[None] == got[0]
    assert {r["verdict"] for r in url_filter.judge(pages, rules.limit(0), default="block").collect()} == {"block"}
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_bloom_has_no_false_negatives(spark):
    rules = spark.createDataFrame([(f"h{i}.org", f"/{i}/", "block") for i in range(5000)], "host string, path string, verdict string")
    bloom = url_filter.bloom_of(rules, "host", "path")
    hashes = np.array([r[0] for r in rules.selectExpr("xxhash64(host, path)").collect()], np.int64)
    assert bloom.has(hashes).all()
    other = np.random.default_rng(0).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    assert bloom.has(other).mean() < 0.02


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), set()
    while True:
        level = (left - sum(most * sizes[s] for s in full)) / sum(w[s] for s in names if s not in full) if len(full) < len(names) else 0
        more = {s for s in names if s not in full and w[s] * level > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else w[s] * level for s in names}
        full |= more


def corpus(spark, n=400):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", "d", "é", None]) if i % 3 else "a", 1, 2) for i in range(n)]
    return spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id long, text string, source string, size int, target int"), [*rows, rows[3], rows[3]]


@pytest.mark.parametrize("bits", [None, 0, 7])
def test_mix_meets_its_targets(spark, monkeypatch, bits):
    if bits is not None:
        monkeypatch.setattr(curriculum, "bucket_bits", lambda rows: bits)
    df, rows = corpus(spark)
    sizes, words = {}, [len((r[1] or "").split()) for r in rows]
    for r, n in zip(rows, words, strict=True):
        sizes[r[2]] = sizes.get(r[2], 0) + n
    want = brute_targets(sizes)
    mixed = curriculum.mix(df).collect()
    by_target = {}
    assert len(mixed) == len(rows) and sorted(r["size"] for r in mixed) == sorted(words)
    source = {r[0]: r[2] for r in rows}
    for r in mixed:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(p["words"] for p in r["passes"])
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
        by_target[source[r["doc_id"]]] = by_target.get(source[r["doc_id"]], 0) + r["taken"]
    for s, t in want.items():
        assert abs(by_target[s] - t) <= 1
    assert sorted((r["doc_id"], r["taken"]) for r in curriculum.mix(df.repartition(7)).collect()) == sorted((r["doc_id"], r["taken"]) for r in mixed)
    order = [r["position"] for r in curriculum.training_order(curriculum.mix(df)).collect()]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1


def test_mix_edges(spark):
    df, _ = corpus(spark)
    assert curriculum.mix(df.limit(0)).count() == 0
    empty = curriculum.mix(spark.createDataFrame([(1, None, "a"), (None, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["taken"], r["position"]) for r in empty] == [(0, 0, None), (0, 0, None)]


@pytest.mark.parametrize("knots", curriculum.SCHEDULES)
def test_schedules_invert(spark, knots):
    from pyspark.sql import functions as F

    ys = spark.range(0, 101).select((F.col("id") / 100).alias("y")).withColumn("t", curriculum.inverse_integral(F.col("y"), knots)).collect()
    t, w = np.linspace(0, 1, 100_001), np.interp(np.linspace(0, 1, 100_001), *zip(*knots, strict=True))
    done = np.concatenate(([0], np.cumsum((w[1:] + w[:-1]) / 2)))
    for r in ys:
        assert np.interp(r["t"], t, done / done[-1]) == pytest.approx(r["y"], abs=1e-6)


def test_chats_keep_maximal_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 2, "user", "ok"), (4, 0, "user", "h"), (5, 0, None, None), (6, 1, "user", "b"), (6, 0, "user", "a"), (7, 0, "user", "h"), (None, 0, "user", "hi"), (8, 0, "user1", "x"), (9, 0, "user", "1x")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert sorted(got) == [3, 4, 5, 6, 8, 9] and got[4]["n_logged"] == 2
    assert got[6]["rendered"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n"
    assert (got[5]["rendered"], got[3]["n_turns"]) == ("<|im_start|>\n<|im_end|>\n", 3)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_archives_round_trip(spark):
    long, other = "x" * 200, "é" * 60
    rows = [(4, "http://a/\r\nX: y", long), (2, None, long), (7, "u", long), (1, "u", "short"), (3, "u", "short"), (5, "u", None), (6, "u", ""), (8, "u", other), (9, "u", other), (None, "u", long), (None, "u", "a\r\n\r\nb")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, digest int, id int")
    got = {r["page_id"]: r for r in warc.archive(df).where("page_id IS NOT NULL").collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for ident, _, html in rows:
        if ident is not None:
            r = got[ident]
            assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), sha(html))
            assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]).decode() == (html or "")
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items() if r["record_type"] == "revisit"} == {4: ("revisit", 2), 7: ("revisit", 2), 9: ("revisit", 8)}
    nameless = {(r["record_type"], r["refers_to"]) for r in warc.archive(df).where("page_id IS NULL").collect()}
    assert nameless == {("revisit", 2), ("response", None)}
    assert warc.archive(df.limit(0)).count() == 0


def test_archives_repeat_rows(spark):
    df = spark.createDataFrame([(1, "u", "x" * 150)] * 3 + [(2, "u", "x" * 150)], "page_id long, url string, html string")
    assert sorted((r["page_id"], r["record_type"]) for r in warc.archive(df).collect()) == [(1, "response")] * 3 + [(2, "revisit")]


def test_archives_keep_any_id(spark):
    ids = ["a\r\nWARC-Type: x", "", None, "é\x00", '"', "null"]
    df = spark.createDataFrame([(i, "u", str(n)) for n, i in enumerate(ids)] + [("a\r\nWARC-Type: y", "u", "y" * 200), ("b: c", "u", "y" * 200), ("long", "u", "z" * 3_000_000)], "page_id string, url string, html string")
    got = warc.archive(df).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in got if r["page_id"] is not None) == sorted([(i, "response") for i in ids if i is not None] + [("a\r\nWARC-Type: y", "response"), ("b: c", "revisit"), ("long", "response")])
    assert sum(r["page_id"] is None for r in got) == 1 and [r["refers_to"] for r in got if r["page_id"] == "b: c"] == ["a\r\nWARC-Type: y"]


def test_damaged_archive_is_noticed():
    import zlib

    raw = warc.make_record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), 3, None)
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    member = packer.compress(raw) + packer.flush()
    assert [b for _, b in warc.read_records(member * 2)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.read_records(member[:-9]))


# --- pipeline ----------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"
COLUMNS = list(pipeline.COLUMNS)


def small(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(90_001, None, "en", "src0", 0), (90_002, "123 ...", "en", "src0", 7), (None, "some plain words without any name", "en", "src0", 1), (None, "some plain words without any name", "en", "src0", 1)], docs.schema)
    return docs.unionByName(odd).unionByName(docs.limit(3))


def brute_groups(texts, shingle=5, at_least=0.8):
    """The first text reachable from each over all pairs of similar shingle sets."""
    from itertools import combinations

    def grams(text):
        w = (text or "").encode().lower().split()
        return frozenset(b" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset()

    sets, parent = [grams(t) for t in texts], list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j]) if min(len(sets[i]), len(sets[j])) >= at_least * max(len(sets[i]), len(sets[j])) else 0
        if sets[i] == sets[j] or both >= at_least * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    return [top(i) for i in range(len(texts))]


def test_pipeline_stages(spark):
    from .test_text_operators import brute_contamination

    docs = small(spark)
    rows = [tuple(r) for r in docs.collect()]
    one = pipeline.identify_language(spark, docs, SF)
    kept = [tuple(r) for r in one.collect()]
    assert one.columns == COLUMNS and {r[0] for r in rows} - {r[0] for r in kept} == {90_001, 90_002}
    two = pipeline.drop_near_copies(spark, one, SF)
    assert two.columns == COLUMNS
    ids = sorted({r[0]: r for r in kept if r[0] is not None}.items())
    groups = brute_groups([r[1] for _, r in ids])
    want = [i for k, (i, _) in enumerate(ids) if groups[k] == k]
    got = [tuple(r) for r in two.collect()]
    assert sorted(r[0] for r in got if r[0] is not None) == want and sum(r[0] is None for r in got) == 1
    three = pipeline.drop_contaminated(spark, two, SF)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = sorted((r for r in got if not brute_contamination(r[1], items)[1]), key=repr)
    assert three.columns == COLUMNS and sorted((tuple(r) for r in three.collect()), key=repr) == clean and len(clean) < len(got)
    four = pipeline.mix_sources(spark, three, SF).collect()
    assert {r["doc_id"] for r in four} <= {r[0] for r in clean} and all(r["taken"] > 0 for r in four)
    assert all(r["taken"] == sum(p["words"] for p in r["passes"]) and r["position"] == r["passes"][0]["position"] for r in four)
    assert sum(r["taken"] for r in four) == pytest.approx(1.5 * sum(len(r[1].split()) for r in clean), rel=0.01)


def test_pipeline_of_nothing(spark):
    docs = small(spark).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("clash", [("Score", "accepted", "i", "version"), ("body", "lang_pred", "component_id", "row"), ("id", "words", "source_size", "c1")])
def test_pipeline_stages_keep_clashing_columns(spark, clash):
    """Columns named like those that the stages work with neither stop a stage nor change."""
    plain = small(spark)
    docs = plain.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in clash))
    for _, stage in pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        rows = got.collect()
        assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in stage(spark, plain, SF).collect()}
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}") for r in rows for c in clash)
    assert pipeline.mix_sources(spark, docs, SF).columns == pipeline.mix_sources(spark, plain, SF).columns


def test_pipeline_stages_after_language_equal_sql(spark):
    """Decontamination and mixing of the stages' own inputs, by SQL over the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'; CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    clean = {r[0] for r in con.sql(f"SELECT doc_id FROM ({queries.decontaminate_sql()}) WHERE NOT contaminated").fetchall()}
    assert {r["doc_id"] for r in pipeline.drop_contaminated(spark, docs, SF).collect()} == clean
    taken = dict(con.sql(f"SELECT doc_id, taken FROM ({queries.curriculum_sql()}) WHERE taken > 0").fetchall())
    assert {r["doc_id"]: r["taken"] for r in pipeline.mix_sources(spark, docs, SF).collect()} == taken


def test_pipeline_near_duplicates_reach_similarity(spark):
    """The stage against all pairs: five-word shingles, similarity 0.8."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = [f"w{i}" for i in range(200)]
    far = [(900_000 + i, " ".join([*words[: 20 * i], "other", *words[20 * i + 1 :]]), "en", "src0", 1) for i in range(1, 9)]
    docs = docs.unionByName(spark.createDataFrame(far, docs.schema))
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    groups = brute_groups([t for _, t in rows])
    stage = dict(pipeline.STAGES)["near_duplicates"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SF).collect()) == [rows[i][0] for i in range(len(rows)) if groups[i] == i]


def test_near_copies_of_repeats_nulls_and_long_texts(spark):
    from fathom.llm import near_copies

    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(5, "a b c d e f g"), (3, "A b c\td e f g"), (None, "a b c d e f g"), (7, ""), (8, None), (9, long), (2, long + " more"), (5, "other words that stand here")]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, node long, keys string")
    got = sorted((r["doc_id"], r["component_id"]) for r in near_copies.near_copies(df).collect())
    assert got == [(2, 2), (3, 3), (5, 3), (5, 3), (7, 7), (8, 7), (9, 2)]
    assert near_copies.near_copies(df.limit(0)).count() == 0


def test_wide_simhashes_of_similar_sets_are_near():
    from fathom.llm import near_copies

    rng = np.random.default_rng(4)
    for size in (16, 40, 700):
        bits = []
        for _ in range(40):
            both = rng.integers(0, 1 << 63, size * 8 // 9 + 1, dtype=np.uint64)
            a, b = (np.concatenate((both, rng.integers(0, 1 << 63, size // 9, dtype=np.uint64))) for _ in range(2))
            bits.append(int(np.bitwise_count((near_copies.wide_simhash(a) ^ near_copies.wide_simhash(b)).view(np.uint64)).sum()))
        assert max(bits) <= near_copies.FAR


def test_simhash_ring_finds_near_copies_itself(spark):
    """The SimHash part alone, without MinHash, against known pairs at a similarity of 0.8 to 0.9, and nothing that is far."""
    from fathom.llm import near_copies

    rng = np.random.default_rng(11)
    rows, pairs = [], []
    for i in range(120):
        words = [f"w{i}x{j}" for j in rng.integers(0, 10_000, 240)]
        cut = int(rng.integers(8, 22))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:100], *(f"n{i}x{j}" for j in range(cut)), *words[100 + cut :]]))]
        a, b = (near_copies.shingle_set(t, 5) for _, t in rows[-2:])
        both = len(np.intersect1d(a, b))
        assert 0.8 <= both / (len(a) + len(b) - both) < 0.92
        pairs.append(tuple(sorted((near_copies.set_node(a), near_copies.set_node(b)))))
    nodes = near_copies.written(near_copies.sketches(spark.createDataFrame(rows, "id long, text string"), 5).select("node", "size", "print"), "nodes")
    found = {(r["a"], r["b"]) for r in near_copies.ring_pairs(nodes, 0.8).collect()}
    assert found <= set(pairs) and len(found) >= 0.9 * len(pairs)
    assert [near_copies.key_bits(n) for n in (0, 200_000, 15_000_000, 1 << 40)] == [24, 24, 30, 32]
