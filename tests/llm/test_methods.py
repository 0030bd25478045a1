"""The methods against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trawl.llm import (attention_lm, bytewords, decontaminate, mixing, quality_ordinal, quality_rules,
                       simhash_cover, substring_cover, url_filter)
from trawl.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"
words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# ---------------------------------------------------------------- words as numpy arrays

@given(st.lists(st.text(alphabet="aB1 \t\n\x0b\x85\xa0é 你-😀"), max_size=6))
@settings(max_examples=150, deadline=None)
def test_byte_words(texts):
    raw = [t.encode() for t in texts]
    for table, low, pattern in ((bytewords.NOT_SPACE, False, r"[^\x20\x09-\x0D]+"),
                                (bytewords.LETTERS_DIGITS, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = bytewords.Words(raw, table, lower=low)
        want = [re.findall(pattern, lower(t) if low else t) for t in texts]
        got = [bytes(w.buf[a:b]).decode() for a, b in zip(w.starts, w.ends, strict=True)]
        assert got == [x for ws in want for x in ws]
        assert np.diff(w.first).tolist() == [len(ws) for ws in want]
        h = w.hashes().tolist()
        assert len(set(h)) == len(set(got)) and dict(zip(got, h, strict=True)) == {g: x for g, x in zip(got, h, strict=True)}


def test_chunks_keep_whole_texts():
    import pyarrow as pa

    texts = ["x" * n for n in (0, 5, 3000, 1, 1, 0, 2500, 7)]
    parts = list(bytewords.chunks(pa.array([*texts, None]), 1000))
    assert [t.decode() for _, p in parts for t in p] == [*texts, ""] and [f for f, _ in parts] == [0, 3, 7]


# ---------------------------------------------------------------- mixing

@pytest.mark.parametrize("targets", [[5.0, 2.0, 1.0], [1000.0, 1000.0, 1000.0], [0.0, 700.0, 333.3, 90.1, 12.0], [3.0]])
def test_quotas_are_the_highest_quotients(spark, targets):
    df = spark.createDataFrame([(f"+{i}", i, 0, t * 37) for i, t in enumerate(targets)],
                               "src string, src_rank int, source_size long, target double")
    got = mixing.shard_quotas(df, block_words=4, shard_blocks=7).collect()
    n = int(sum(targets) * 37 / 4 + 0.5)
    seats = sorted(((-t * 37 / (2 * k - 1), i) for i, t in enumerate(targets) if t for k in range(1, n + 2)))[:n]
    for shard in range(-(-n // 7)):
        want = [0] * len(targets)
        for _, i in seats[7 * shard:7 * shard + 7]:
            want[i] += 1
        have = {int(r["src"][1:]): r["quota"] for r in got if r["shard"] == shard}
        assert [have.get(i, 0) for i in range(len(targets))] == want


def test_mix_is_near_its_targets_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = ["doc_id", "source", "size", "source_size", "target", mixing.taken_words(F.col("takes")).alias("taken")]
    a = sorted(mixing.mix_sources(docs).select(*cols).collect())
    b = sorted(mixing.mix_sources(docs.repartition(5)).select(*cols).collect())
    assert a == b
    taken = {}
    for r in a:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(n - t) <= mixing.BLOCK_WORDS for n, t in taken.values())
    assert abs(sum(t for _, t in taken.values()) - 1.5 * sum(r["size"] for r in a)) < 1e-6


def test_shards_hold_their_quotas(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    size = {"block_words": 16, "shard_blocks": 300}
    mix = mixing.mix_sources(docs, **size).cache()
    quotas = mixing.shard_quotas(mixing.source_targets(mixing.document_sizes(docs)), **size).cache()
    pieces = mixing.shard_pieces(mix, quotas, **size).cache()
    n = F.sum(F.col("to_word") - F.col("from_word")).alias("n")
    taken = {r["doc_id"]: r["t"] for r in mix.select("doc_id", mixing.taken_words(F.col("takes")).alias("t")).collect() if r["t"]}
    assert {r["doc_id"]: r["n"] for r in pieces.groupBy("doc_id").agg(n).collect()} == taken
    quota = {(r["shard"], r["src"]): r["quota"] * 16 for r in quotas.collect() if r["quota"]}
    held = {(r["shard"], "+" + r["source"]): r["n"] for r in pieces.groupBy("shard", "source").agg(n).collect()}
    assert held.keys() <= quota.keys() and all(0 <= quota[k] - held.get(k, 0) <= 16 for k in quota)


# ---------------------------------------------------------------- decontamination

@given(st.lists(st.lists(st.integers(0, 3), max_size=9), min_size=1, max_size=6),
       st.lists(st.integers(0, 4), max_size=40), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_automaton_matches_brute_force(items, doc, window):
    named = [(str(i), [f"w{x}" for x in ws]) for i, ws in enumerate(items)]
    doc = [f"w{x}" for x in doc]
    hit, names = set(), set()
    for name, ws in named:
        k = min(window, len(ws))
        grams = {tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)} if ws else set()
        for i in range(len(doc) - k + 1):
            if k and tuple(doc[i:i + k]) in grams:
                hit |= set(range(i, i + k))
                names.add(name)
    m = decontaminate.Matcher(named, window)
    got = m.match(bytewords.Words([b"", " ".join(doc).encode()], bytewords.LETTERS_DIGITS)).get(1)
    assert (set() if got is None else {p for a, b in got.spans for p in range(a, b)}) == hit
    assert ([] if got is None else got.items) == sorted(names)


def test_long_items_keep_every_window(spark):
    ws = [f"v{i}" for i in range(95)]
    items = spark.createDataFrame([(1, " ".join(ws))], "item_id long, text string")
    docs = spark.createDataFrame([(i, " ".join(ws[i:i + 10])) for i in range(86)], "doc_id long, text string")
    out = decontaminate.match_items(docs, items, piece_words=20, block_words=30)
    assert out.where(F.size("items") == 1).count() == 86


def test_removed_spans_leave_no_window(spark):
    rng = random.Random(1)
    item, other = [f"i{k}" for k in range(24)], [f"o{k}" for k in range(12)]
    around = [[f"d{rng.randrange(10**6)}" for _ in range(60)] for _ in range(4)]
    docs = spark.createDataFrame([
        (1, " ".join(around[0])), (2, " ".join(around[1][:30] + item[3:20] + around[1][30:])), (3, " ".join(item)),
        (4, " ".join(around[2] + item[:8] + other + item[8:16] + around[3]))], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item)), (8, " ".join(other))], "item_id long, text string")
    out = {r["doc_id"]: r["text"].split() for r in decontaminate.remove_spans(docs, items).collect()}
    assert out == {1: around[0], 2: around[1], 4: around[2] + around[3]}


# ---------------------------------------------------------------- SimHash

def brute_components(texts, n, bits):
    fps = {}
    for i, t in texts.items():
        w = words_of(lower(t or ""))
        sh = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
        hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    group = {i: i for i in fps}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    return {i: (f"{fps[i]:016x}", top(i)) for i in ids}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_near_duplicates_match_brute_force(spark, bits):
    rng = random.Random(3)
    texts = {}
    for i in range(40):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts[10 * i + 5] = " ".join(base)
        for j in range(4):
            ws = list(base)
            for _ in range(j + 1):
                ws[rng.randrange(len(ws))] = "Changed"
            texts[10 * i + j] = " ".join(ws)
    texts.update({1000: None, 1001: "", 1002: "one", 1003: "ONE", 1004: "two words", 1005: "\n \t"})
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["f"], r["component_id"]) for r in simhash_cover.near_duplicates(docs, max_bits=bits).select(
        "doc_id", simhash_cover.fingerprint_hex(F.col("fp")).alias("f"), "component_id").collect()}
    want = brute_components(texts, 3, bits)
    assert got == want
    if bits == 2:
        assert 1 < len({c for _, c in want.values()}) < 160  # there is something to link


def test_anchors_cover_every_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300, dtype=np.uint64)
    assert (np.bitwise_count(simhash_cover.nearest_anchor(x) ^ x) <= 1).all()
    for t in (1, 2, 3, 4):
        y = x.copy()
        for _ in range(t):
            y ^= np.uint64(1) << rng.integers(0, 64, 300, dtype=np.uint64)
        cells = [{}, {}]
        for side, points in enumerate((x, y)):
            who, anchor = simhash_cover.anchors_of(points, t)
            for i, a in zip(who.tolist(), anchor.tolist(), strict=True):
                cells[side].setdefault(i, set()).add(a)
        assert all(cells[0][i] & cells[1][i] for i in range(300))


@given(st.lists(st.integers(0, 255), min_size=1, max_size=25, unique=True), st.integers(0, 3))
@settings(max_examples=80, deadline=None)
def test_spanning_links_connect_what_is_linked(points, bits):
    def parts(links):
        group = {p: {p} for p in points}
        for a, b in links:
            joined = group[int(a)] | group[int(b)]
            for p in joined:
                group[p] = joined
        return {frozenset(g) for g in group.values()}
    links = simhash_cover.spanning_links(np.array(points, dtype=np.uint64), bits)
    assert len(links) < len(points) and all((int(a) ^ int(b)).bit_count() <= bits for a, b in links)
    assert parts(links) == parts([(a, b) for a in points for b in points if (a ^ b).bit_count() <= bits])


# ---------------------------------------------------------------- substring dedup

@pytest.mark.parametrize("window,period,cover,bits", [(13, 7, (0, 1, 3), 28), (5, 3, (0, 1), 13), (3, 3, (0, 1), 13)])
def test_substrings_match_brute_force(spark, window, period, cover, bits):
    rng = random.Random(window)
    passages = [[f"p{rng.randrange(9)}" for _ in range(rng.randrange(4, 40))] for _ in range(6)]
    texts = {}
    for i in range(80):
        ws = []
        for _ in range(rng.randrange(1, 5)):
            ws += rng.choice(passages)[rng.randrange(3):] if rng.random() < .6 else [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(9))]
        texts[rng.randrange(10**6)] = " ".join(ws)
    least, where = {}, {}
    for i, t in texts.items():
        ws = t.split()
        where[i] = [tuple(ws[k:k + window]) for k in range(len(ws) - window + 1)]
        for g in where[i]:
            least[g] = min(i, least.get(g, i))
    want = {}
    for i, t in texts.items():
        gone = {p for k, g in enumerate(where[i]) if least[g] < i for p in range(k, k + window)}
        want[i] = " ".join(w for p, w in enumerate(t.split()) if p not in gone)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = substring_cover.dedup_substrings(docs, window, period, cover, bits).collect()
    assert {r["doc_id"]: r["kept_text"] for r in got} == want
    assert any(r["n_removed"] for r in got)


# ---------------------------------------------------------------- classifier, rules, urls

def test_classifier_finds_held_out_grades(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0
    grades = quality_ordinal.graded_labels(labels)
    model = quality_ordinal.fit_ordinal(*quality_ordinal.labelled_features(docs, grades.where(~held)))
    assert (np.diff(model.thresholds) > 0).all()
    out = quality_ordinal.score_quality(docs, model, 2).join(grades.where(held), "doc_id").toPandas()
    rates = out.assign(kept=out["tail_probability"] >= 0.5).groupby("grade")["kept"].mean()
    assert rates[0] < 0.3 and rates[1] < 0.4 and rates[2] > 0.95
    means = out.groupby("grade")["expected_grade"].mean()
    assert means[0] < means[1] < means[2]


def test_quality_rules_keep_good_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_rules.judge_quality(docs).join(labels, "doc_id").where("not base_failed").toPandas()
    assert out[out.quality == 1].kept.mean() > 0.97 and out[out.quality == 0].kept.mean() < 0.1


def test_quality_limits_at_any_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(quality_rules.judge_quality(d).select("doc_id", "kept", "limit_caps_mille").collect())
            for d in (docs, docs.repartition(7)))
    assert a == b


@given(st.integers(0, 10**7), st.integers(0, 10**7))
@settings(max_examples=50, deadline=None)
def test_sketch_bins_are_ordered_and_close(x, y):
    def bin_of(v):
        unit = 2 ** max(v.bit_length() - 6, 0)
        return v - v % unit
    assert v_close(x, bin_of(x)) and (bin_of(x) <= bin_of(y)) == (x <= y or bin_of(x) == bin_of(y))


def v_close(v, b):
    return b <= v and v - b <= v / 32


def test_url_model_separates_words(spark):
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    urls = [("http://best-casino-poker.example.org/en/", "block"), ("https://www.spam-farm.example.com/es/4", "block"),
            ("https://www.science-library.example.org/en/5", "allow"), ("http://garden.example.com/en/9", "allow")]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, model).collect()}
    assert [got[i] for i in range(len(urls))] == [v for _, v in urls]


def test_rules_match_brute_force(spark):
    rng = random.Random(2)
    hosts = ["net", "a.net", "example.net", "Sub.Example.NET", "xexample.net", "example.com", "b.example.com", "org", "x.org", "xorg"]
    paths = ["", "/", "/en/", "/en", "/en/1", "/de/", "/de/2", "/fr/", "/fr/x", "/FR/x", "/en/?a/de/", "/fr#x"]
    urls = [f"{rng.choice(['http', 'x', ''])}://{h}{p}" for h in hosts for p in paths]
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    model = url_filter.fit_url_model(url_filter.labelled_urls(spark))
    got = {r["page_id"]: r for r in url_filter.filter_urls(
        spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), model).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = lower(host)
        fits = [r for r in rules for h, p in [r.split("/", 1)]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        best = max(fits, key=len, default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best)
        assert best is None or got[i]["verdict"] == rules[best]


# ---------------------------------------------------------------- language model

def small_model(seed=1, n=3000):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 40, n).astype(np.int32)
    counts = np.bincount(ids, minlength=attention_lm.VOCABULARY).astype(float)
    return attention_lm.initial_weights(counts), ids


def test_next_id_distribution_sums_to_one():
    flat, _ = small_model()
    everything = np.arange(attention_lm.VOCABULARY, dtype=np.int32)
    prefix = np.array([5, 7, 9], dtype=np.int32)
    texts = [np.append(prefix, x) for x in everything]
    win, first = attention_lm.windows_of(np.concatenate(texts), np.full(len(texts), 4))
    lp = attention_lm.Scorer(flat).log_probs(win)
    assert abs(np.exp(lp[:, 3].astype(float)).sum() - 1) < 1e-3


def test_every_id_is_scored_once_and_causally():
    flat, ids = small_model()
    counts = np.array([1, 16, 17, 100, 0, 33])
    ids = ids[:counts.sum()]
    win, first = attention_lm.windows_of(ids, counts)
    assert win.real.sum() == counts.sum() and (win.targets[win.real] == ids).all()
    lp = attention_lm.Scorer(flat).log_probs(win)
    later = ids.copy()
    later[-1] = (later[-1] + 1) % 40  # the last id of the last text changes nothing before it
    win2, _ = attention_lm.windows_of(later, counts)
    lp2 = attention_lm.Scorer(flat).log_probs(win2)
    assert np.array_equal(lp[win.real][:-1], lp2[win.real][:-1])
    alone, _ = attention_lm.windows_of(ids[34:134], np.array([100]))  # a text alone scores as among others
    np.testing.assert_allclose(attention_lm.Scorer(flat).log_probs(alone).sum(), lp[first[3]:first[4]].sum(), rtol=1e-5)


def test_gradient_matches_differences():
    flat, ids = small_model()
    win, _ = attention_lm.windows_of(ids[:200], np.array([120, 80]))
    flat = flat.astype(np.float64)
    loss, g = attention_lm.loss_and_gradient(flat, win)
    rng = np.random.default_rng(4)
    for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-5), 60):
        ends = []
        for e in (1e-5, -1e-5):
            moved = flat.copy()
            moved[i] += e
            ends.append(attention_lm.loss_and_gradient(moved, win)[0])
        assert abs((ends[0] - ends[1]) / 2e-5 - g[i]) < 1e-5 + 1e-3 * abs(g[i])


def test_training_learns_a_pattern():
    ids = np.tile(np.arange(1, 30, dtype=np.int32), 200)
    flat = attention_lm.initial_weights(np.bincount(ids, minlength=attention_lm.VOCABULARY).astype(float))
    win, _ = attention_lm.windows_of(ids, np.array([len(ids)]))
    before = attention_lm.loss_and_gradient(flat, win)[0]
    trained, _ = attention_lm.train(flat, win, batch=64, min_steps=300)
    assert attention_lm.loss_and_gradient(trained, win)[0] < 0.3 * before


def test_base_score_matches_brute_force(spark):
    import collections
    import math

    import public_tokenizers

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        got = {r["doc_id"]: r for r in attention_lm.score_texts(docs, f.read(), head_words=50).collect()}
    words = {r["doc_id"]: words_of(lower(r["text"] or "")) + [None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in words}
    c = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n = sum(c.values())
    for i, ws in words.items():
        base = sum(math.log10((c.get(w, 0) + 0.1) / (n + 0.1 * (len(c) + 1))) for w in ws)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[i], len(ws), sum(c.get(w, 0) > 0 for w in ws), n)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_matches_its_stages_by_brute_force(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "source mixing"]
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.judge_quality(docs).collect()}
    a = stages["quality rules"](spark, docs, sf).cache()
    assert a.columns == columns and {r["doc_id"] for r in a.collect()} == {i for i, k in verdict.items() if k}
    sites, first = {}, {}
    for r in sorted(a.collect()):
        for p, x in enumerate(r["text"].split("\n")):
            if x.strip(" \t\n\x0b\x0c\r"):
                sites.setdefault(x, set()).add(r["source"])
                first.setdefault(x, (r["doc_id"], p))
    b = stages["line dedup"](spark, a, sf).cache()
    want = {r["doc_id"]: "\n".join(x for p, x in enumerate(r["text"].split("\n")) if len(sites.get(x, ())) < 5
                                   or first[x] == (r["doc_id"], p)) for r in a.collect()}
    assert b.columns == columns and {r["doc_id"]: r["text"] for r in b.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in b.collect())
    groups = brute_components(want, 3, 2)
    c = stages["simhash near-dedup"](spark, b, sf).cache()
    assert c.columns == columns and {r["doc_id"] for r in c.collect()} == {i for i, (_, k) in groups.items() if i == k}
    d = stages["benchmark decontamination"](spark, c, sf).cache()
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert d.columns == columns and decontaminate.match_items(d, items).where(F.size("spans") > 0).count() == 0
    clean = {r["doc_id"] for r in decontaminate.match_items(c, items).where(F.size("spans") == 0).collect()}
    text = {r["doc_id"]: r["text"] for r in c.collect()}
    assert {r["doc_id"]: r["text"] for r in d.collect() if r["doc_id"] in clean} == {i: text[i] for i in clean}
    e = stages["source mixing"](spark, d, sf)
    assert sorted(r["doc_id"] for r in e.collect()) == sorted(r["doc_id"] for r in d.collect())
    assert sorted(P.run(spark, sf).collect()) == sorted(e.collect())


def test_registered_queries():
    assert sorted({int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES}) == list(range(1, 11))
