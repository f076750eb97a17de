"""The ten operators against brute force on small tables with nulls, ties, repeated rows,
empty and long texts and extra columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import byte_pairs, embedding_dedup, exact_dedup, language, line_dedup, mixing, ngram_join, packing, queries, shared, substring_dedup, url_filter
from docweave.llm.apportion import sainte_lague
from tests.conftest import SF, rows_of

DOCS = "doc_id long, text string, source string, lang string, token string, key long, node string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def _vocabulary(name):
    return queries._vocabulary(name)


def _lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "한국", "the,", "don't"]
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [None, "", " \n\t", "one", "a b c d", "A b C d", "a b c d e", "x" * 5000, "a b " * 60, passage]
    base = [" ".join(r.choice(words) for _ in range(r.choice([6, 30, 120]))) for _ in range(12)]
    for _ in range(60):
        t = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 3])):
            t[r.randrange(len(t))] = r.choice(words)
        texts.append(" ".join(t) + (" " + passage if r.random() < 0.3 else ""))
    texts += [" ".join(r.choice(words) for _ in range(9000))]
    ids = [i * 3 % 211 for i in range(len(texts))]
    out = [(i, t, r.choice(["b", "a", None, "ü"]), r.choice(["en", "fr", None]), "x", 1, "n") for i, t in zip(ids, texts, strict=True)]
    return out + [out[12], (None, base[0], None, None, "x", 1, "n"), (None, "Base", "a", "en", "x", 1, "n")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_embeddings(spark):
    r = np.random.default_rng(1)
    a = r.normal(size=(150, 64))
    x = np.concatenate([a, a[:60] + r.normal(size=(60, 64)) * 0.25, a[:1] + r.normal(size=(80, 64)) * 0.1])
    table = [(i, [float(z) for z in v]) for i, v in enumerate(x)]
    table += [(900, None), (901, [0.0] * 64), (902, [float("nan")] * 64), (903, [None] * 64), (904, []), (None, table[0][1]), table[3], (905, table[0][1])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumn("key", F.lit(1))
    x = np.concatenate([x, x[:1]])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    adj = u @ u.T >= 0.9
    np.fill_diagonal(adj, False)
    ids = [*range(len(x) - 1), 905]
    for chunk in (2048, 20):
        got = {g.vec_id: g for g in embedding_dedup.near_vectors(df, chunk=chunk).collect()}
        found = sum(got[i].n_links for i in ids)
        assert 0.98 * adj.sum() <= found <= adj.sum()
        assert got[905].component_id == 0 and not got[905].kept and got[None].n_links == 0 and got[None].component_id is None
        assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903, 904))
    assert embedding_dedup.near_vectors(df.filter("false")).count() == 0


def test_ngram_join(docs, rows):
    sets = defaultdict(list)
    want = []
    for k, (i, t, *_) in enumerate(rows):
        w = WORDS.findall(_lower(t or ""))
        sets[k] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = defaultdict(list)
    for k, r in enumerate(rows):
        low[root(k)].append(r[0])
    for k, r in enumerate(rows):
        named = [i for i in low[root(k)] if i is not None]
        want.append((r[0], len(sets[k]), min(named) if r[0] is not None else None))
    got = _sorted(ngram_join.ngram_components(docs))
    assert got == sorted(want, key=str)
    assert ngram_join.ngram_components(docs.filter("false")).count() == 0
    kept = ngram_join.ngram_dedup(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[0] is None or w[0] == w[2]}


def test_boundary_follows_cost():
    assert ngram_join.boundary({}, 1, 4, 5) == ngram_join.MOST_SMALL
    few, many = ngram_join.boundary({n: 10 for n in range(17)}, 1, 4, 5), ngram_join.boundary({n: 10 for n in range(17)}, 100, 4, 5)
    assert 1 <= few < many


def test_ngram_frequent_passage_and_group(spark):
    hot = " ".join(f"hot{i}" for i in range(30))
    r = random.Random(2)
    out = [(i, " ".join(f"u{i}x{j}" for j in range(20)) + " " + hot) for i in range(150)]
    near = [f"n{j}" for j in range(100)]
    for i in range(150, 300):
        t = list(near)
        t[r.randrange(100)] = f"edit{i}"
        out.append((i, " ".join(t)))
    got = {g.doc_id: g.component_id for g in ngram_join.ngram_components(spark.createDataFrame(out, "doc_id long, text string")).collect()}
    assert all(got[i] == i for i in range(150)) and {got[i] for i in range(150, 300)} == {150}


def test_ngram_long_sets_near_the_threshold(spark):
    """Texts over LONG_SET that share 78 to 80.3 % of their shingles, one in a group of copies."""
    r = random.Random(8)
    head = [f"h{r.randrange(10**9)}" for _ in range(1000)]
    texts = [" ".join(head + [f"t{i}x{r.randrange(10**9)}" for _ in range(m)]) for i, m in enumerate([*range(122, 136), 122, 124])]
    texts += [texts[0]] * 3
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((parent[i], parent[j]))
                parent = [low if x == high else x for x in parent]
    assert 1 < len(set(parent)) < len(texts)
    got = ngram_join.ngram_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {g.doc_id: g.component_id for g in got} == dict(enumerate(parent))


def test_components_equal_brute_force(spark):
    """A chain, a random forest's edges with repeats, a star, a ring, nulls and loops."""
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    edges += [(r.randrange(300, 360), r.randrange(300, 360)) for _ in range(40)] * 2 + [(None, 5), (7, 7), (999, 999)]
    real = [(a, b) for a, b in edges if a is not None and a != b]
    low = {n: n for e in real for n in e}
    for _ in low:
        for a, b in real:
            low[a] = low[b] = min(low[a], low[b])
    got = shared.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(low) and {g.node: g.component for g in got} == low
    assert shared.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_token_counts(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(_vocabulary("byte_bpe_50k.json"))
    want = sorted(((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 512) for i, x, *_ in rows), key=str)
    assert _sorted(byte_pairs.count_tokens(docs, _vocabulary("byte_bpe_50k.json"))) == want
    assert byte_pairs.count_tokens(docs.filter("false"), _vocabulary("byte_bpe_50k.json")).collect() == []
    counter, r = byte_pairs.PairCounter(_vocabulary("byte_bpe_50k.json")), random.Random(1)
    bits = ["a", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "é", "\u00a0", "\u3000", "12", ".", "\x1c", "\x85", "한국", "😀", "The", "\x00"]
    for _ in range(3000):
        s = "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
        assert counter.of_text(s) == len(t.encode(s, add_special_tokens=False).ids), s


def test_token_counts_of_mixed_white_space(spark):
    """Runs of white space that alternate spaces with others are one word of the split."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(_vocabulary("byte_bpe_50k.json"))
    counter, r = byte_pairs.PairCounter(_vocabulary("byte_bpe_50k.json")), random.Random(4)
    texts = [" \u00a0 \u00a0", "a \u00a0 \u00a0 \u00a0b", "\u00a0 \u00a0 a", "a \u00a0 \u00a0<|endoftext|>  b", "  \u00a0  \u00a0x", "\n \n \n x"]
    bits = [" ", " ", "\u00a0", " \u00a0", "\n", "\t", "\u3000", "\u2009", "\x85", "\x1c", "a", "'s", ".", "7", "<|endoftext|>", "<|", "한"]
    texts += ["".join(r.choice(bits) for _ in range(r.randint(1, 14))) for _ in range(4000)]
    assert counter.of_text(texts[0]) == 1
    for s in texts:
        assert counter.of_text(s) == len(t.encode(s, add_special_tokens=False).ids), s
    got = byte_pairs.count_tokens(spark.createDataFrame(list(enumerate(texts[:6])), "doc_id long, text string"), _vocabulary("byte_bpe_50k.json"))
    assert [x.n_tokens for x in got.orderBy("doc_id").collect()] == [len(t.encode(s, add_special_tokens=False).ids) for s in texts[:6]]


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(_vocabulary("word_bpe_49k.json"))
    got = packing.pack(docs, _vocabulary("word_bpe_49k.json")).toPandas()
    want = []
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(i, p, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for p, s in enumerate(range(0, len(ids), 4096))]
    assert rows_of(got[["doc_id", "piece", "start", "length", "ids_crc32"]]) == sorted(((c[4], c[0]) and (c[0], c[4], c[3], c[1], c[2]) for c in want), key=str)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 4096
    words = packing.WordIds(_vocabulary("word_bpe_49k.json"))
    for s in ("A\x1cb \x85c", "<|endoftext|> e\u0301 \u0301x", "ΑΣ İ ß don't", "\u2000\u00a0"):
        assert words.of_texts([s])[0] == np.array(t.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.pack(docs.filter("false"), _vocabulary("word_bpe_49k.json")).count() == 0


def test_best_fit():
    b = packing.BestFit(10, 2)
    assert [b.place(n) for n in (6, 7, 3, 4, 9, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (2, 9)]
    b = packing.BestFit(10, 2)
    assert [b.place(n)[0] for n in (5, 8, 9, 2)] == [0, 1, 2, 0]  # the fullest, bin 1, closed for bin 2


def _repeats(rows, n=20):
    big, first, docs = 1 << 70, {}, []
    for i, t, *_ in rows:
        docs.append((i, big if i is None else i, (t or "").encode().split()))
    for _, k, w in docs:
        for j in range(len(w) - n + 1):
            first[tuple(w[j : j + n])] = min(first.get(tuple(w[j : j + n]), (1 << 80, 0)), (k, j))
    out = []
    for i, k, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first[tuple(w[j : j + n])] < (k, j):
                gone[j : j + n] = [True] * n
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("most_copies", [0, 2_000_000])
def test_substring_dedup(docs, rows, most_copies, monkeypatch):
    monkeypatch.setattr(substring_dedup, "MOST_COPIES", most_copies)
    assert _sorted(substring_dedup.remove_repeats(docs).drop("kept")) == _repeats(rows)
    assert substring_dedup.remove_repeats(docs.filter("false")).count() == 0


def test_substring_dedup_with_a_full_sketch(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "LEAST_LOG", 6)
    monkeypatch.setattr(substring_dedup, "MOST_LOG", 6)
    assert _sorted(substring_dedup.remove_repeats(docs).drop("kept")) == _repeats(rows)


def test_sainte_lague(spark):
    r = random.Random(3)
    for seats in (0, 1, 7, 100):
        claims = [(g, k, r.choice([0, 1, 5, 1000, r.randrange(1, 300)]), seats) for g in "ab" for k in range(9)]
        got = sainte_lague(spark.createDataFrame(claims, "g string, k int, w long, s long"), ["g"], ["k"], "w", "s")
        have = {(x.g, x.k): x.quota for x in got.collect()}
        for g in "ab":
            w, q = {k: v for h, k, v, _ in claims if h == g}, dict.fromkeys(range(9), 0)
            for _ in range(seats):
                k = max(range(9), key=lambda k: (w[k] / (2 * q[k] + 1), -k))
                q[k] += 1
            assert {k: have[g, k] for k in q} == q


def test_mixing(docs, rows, spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.mix_sources(d).join(d.select("doc_id", "source"), "doc_id").toPandas()
    assert (got["taken"] <= 2 * got["size"]).all() and (got["taken"] >= 0).all()
    by = got.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by["source_size"]).all() and abs(by["target"].sum() - 1.5 * by["size"].sum()) < 1
    assert ((by["taken"] - by["target"]).abs() <= 128).all()
    weights = dict(zip(sorted(by.index), [3, 1, 2] * 20, strict=False))
    level = max((by["target"] / by.index.map(weights))[by["target"] < 2 * by["size"] - 1e-6])
    for s, b in by.iterrows():
        assert abs(b["target"] - min(2 * b["size"], level * weights[s])) < 1e-3
    assert rows_of(mixing.mix_sources(d).toPandas()) == rows_of(mixing.mix_sources(d.repartition(3)).toPandas())
    small = mixing.mix_sources(docs).toPandas()
    assert len(small) == len(rows) and (small["taken"] <= 2 * small["size"]).all()
    assert mixing.mix_sources(docs.filter("false")).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


@pytest.mark.parametrize("words", [20, 300, 1000])
def test_mixed_documents_keep_the_quotas(spark, words):
    """Sources that take 0.5, 0.4 and 1.2 of their words, of several shards each: the words of whole documents come near the targets."""
    r = random.Random(words)
    counts = {"a": 120000, "b": 50000, "c": 35000}
    table = []
    for s, n in counts.items():
        while n > 0:
            k = min(n, r.randint(words // 2, 3 * words // 2))
            table.append((len(table), "w " * k, s))
            n -= k
    docs = spark.createDataFrame(table, "doc_id long, text string, source string")
    options = {"weights": (3.0, 1.0, 2.1), "share": 122000 / 205000, "shard": 20000}
    targets = dict(mixing.mix_sources(docs, **options).join(docs, "doc_id").groupBy("source").agg(F.first("target")).collect())
    kept = mixing.mixed_documents(docs, **options).groupBy("source").agg(F.sum(F.regexp_count("text", F.lit("w")))).collect()
    assert targets["a"] == pytest.approx(60000, rel=0.01) and targets["c"] == pytest.approx(42000, rel=0.01)
    shards = {s: -(-n // options["shard"]) for s, n in counts.items()}
    assert len(kept) == 3 and all(abs(n - targets[s]) <= shards[s] * (3 * words // 4 + 64) + 64 for s, n in kept)
    assert all(abs(n - targets[s]) <= 0.05 * targets[s] for s, n in kept)


def test_urls(spark):
    urls = ["http://A.Com/x?q", "https://www.example.com/en/1", "https://b.example.com/en/", "b.net/es/", "http://b.net/es/1#t", "http://net/fr/", "http://xnet/fr/", None, "http://com", "x://y://z/w", "http://example.com/EN/", "http://h.org\n/p\nq"]
    pages = spark.createDataFrame([*enumerate(urls), (None, urls[0]), (0, urls[0])], "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(11, 0, 1), (11, 1, 1), (500, 0, 0), (None, 0, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {(r.page_id, r.host, r.path, r.rule) for r in url_filter.filter_urls(pages, labels).collect()}
    assert {(0, "a.com", "/x", "com/"), (1, "www.example.com", "/en/1", "www.example.com/en/"), (2, "b.example.com", "/en/", "example.com/en/"), (3, "", "", None), (4, "b.net", "/es/1", "net/es/"),
            (5, "net", "/fr/", "net/fr/"), (6, "xnet", "/fr/", None), (7, "", "", None), (8, "com", "", None), (9, "y:", "//z/w", None), (10, "example.com", "/EN/", "com/"), (None, "a.com", "/x", "com/")} <= got
    out = url_filter.filter_urls(pages, labels)
    assert out.count() == 14 and {r.verdict for r in out.collect()} <= {"allow", "block"}
    assert url_filter.filter_urls(pages.filter("false"), labels.filter("false")).count() == 0
    bad = spark.createDataFrame([(i, f"http://bad{i % 2}.org/") for i in range(80)], "page_id long, url string")
    seen = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    assert {(r.host, r.verdict) for r in url_filter.filter_urls(bad, seen).collect()} == {("bad0.org", "block"), ("bad1.org", "allow")}


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_exact(docs, rows, keep, best, monkeypatch):
    for hot in (500, 3):
        monkeypatch.setattr(exact_dedup, "HOT_COPIES", hot)
        groups = defaultdict(list)
        for i, t, *_ in rows:
            groups[_lower(t or "")].append(i)
        want = []
        for t, ids in groups.items():
            named = [i for i in ids if i is not None]
            k = best(named) if named else None
            want += [(i, k, len(ids), i == k, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
        assert _sorted(exact_dedup.exact_groups(docs, keep)) == sorted(want, key=str)
        assert exact_dedup.exact_dedup(docs, keep).count() == sum(w[3] for w in want)
    assert exact_dedup.exact_groups(docs.filter("false")).count() == 0


def test_language(spark, docs):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.predict_languages(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97 and out["score"].between(0, 1).all()
    model = language.learn(d)
    en, fr = d.filter("lang = 'en'").first().text[:300], d.filter("lang = 'fr'").first().text[:300]
    mixed = spark.createDataFrame([(1, f"{en} {fr}"), (2, None), (3, "12 !"), (4, ""), (None, "the of")], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(mixed, model, spans=True).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "fr"] and [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and got[2].score == 0
    none = language.learn(d.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.identify(mixed, none).collect()} == {"und"}
    assert language.predict_languages(docs.filter("false")).count() == 0 and language.keep_identified(docs).columns == docs.columns


def test_documents_of_several_languages_stay(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    text = {k: d.filter((F.col("lang") == k) & (F.length("text") > 400)).first().text for k in ("en", "fr", "de", "es")}
    r = random.Random(6)
    mixed = {
        1001: " ".join([text["en"][:200], text["fr"][:150], text["de"][:150]]), 1002: " ".join([text["es"][:150], text["de"][:150], text["en"][:150]]),
        1003: " ".join([text["fr"][:210], text["en"][:200]]), 1004: " ".join([text["de"][:200], text["es"][:200]]), 1005: " ".join(t[:200] for t in text.values()),
    }
    no_words = {2001: None, 2002: "12 !", 2003: "".join(r.choice("qxzjkvw ") for _ in range(300)), 2004: "".join(r.choice("абвгдежзик ") for _ in range(300))}
    more = spark.createDataFrame([*mixed.items(), *no_words.items()], "doc_id long, text string")
    kept = {x.doc_id for x in language.keep_identified(d.unionByName(more, allowMissingColumns=True)).collect()}
    assert {x for x in kept if x > 1000} == set(mixed)
    assert {x.doc_id for x in d.select("doc_id").collect()} <= kept
    alone = d.filter("lang = 'en'")  # a corpus of one language is explained too
    assert language.keep_identified(alone).count() == alone.count()


def test_viterbi_equals_brute_force():
    from itertools import product

    r = np.random.default_rng(4)
    lengths = [0, 1, 5, 6, 3, 0]
    e = r.normal(size=(sum(lengths), 3)) * 3
    first = np.cumsum([0, *lengths])
    got = language.viterbi(e, first[:-1], first[1:], 2.0)
    for a, b in zip(first[:-1], first[1:], strict=True):
        value = lambda p: sum(e[a + i, k] for i, k in enumerate(p)) - 2.0 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
        assert list(got[a:b]) == list(max(product(range(3), repeat=b - a), key=value))


def _one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


@pytest.mark.parametrize("broadcast,hot", [(1_000_000, 500), (0, 2)])
def test_line_dedup(spark, broadcast, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_BROADCAST", broadcast)
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    r, big = random.Random(2), 1 << 70
    base = ["".join(r.choice("abcé 한") for _ in range(n)) for n in (5, 19, 20, 21, 30, 60, 200, 200, 48, 49, 25)]

    def edit(x):
        i, c = r.randrange(len(x)), r.choice("abcé 한")
        return r.choice([x[:i] + x[i + 1 :], x[:i] + c + x[i:], x[:i] + c + x[i + 1 :], x])

    table = [(d if d % 9 else None, "\n".join(edit(edit(r.choice(base))) for _ in range(6)) + "\n\n") for d in range(1, 60)][:54]
    table = list({t[0]: t for t in table}.values()) + [(500, None), (501, ""), (502, " \n\n"), (1, table[0][1])]
    first = {}
    for d, t in table:
        for p, x in enumerate((t or "").split("\n")):
            if x.strip():
                first[x] = min(first.get(x, (big * 2, 0)), (big if d is None else d, p))
    bad = {a for a in first for b in first if first[b] < first[a] and len(a) >= 20 and len(b) >= 20 and _one_edit(a, b)}
    want = []
    for d, t in table:
        lines = (t or "").split("\n")
        kept = [x for p, x in enumerate(lines) if not x.strip() or (first[x] == (big if d is None else d, p) and x not in bad)]
        want.append((d, None if t is None else "\n".join(kept), 0 if t is None else len(lines), len(lines) - len(kept)))
    df = spark.createDataFrame(table, "doc_id long, text string")
    got = line_dedup.dedup_lines(df.withColumn("id", F.lit(1)), least_chars=20).select("doc_id", "text", "n_lines", "n_removed")
    assert bad and _sorted(got) == sorted(want, key=str)
    assert line_dedup.dedup_lines(df.filter("false")).count() == 0


@pytest.mark.parametrize("least,hot", [(0, 500), (0, 2), (12, 500), (25, 500)])
def test_line_dedup_of_short_lines(spark, least, hot, monkeypatch):
    """Lines of 1 to 27 characters against brute force, and op10 takes lines of every length."""
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    r = random.Random(9)
    base = ["".join(r.choice("abé 한") for _ in range(n)) for n in (1, 2, 3, 6, 10, 13, 18, 19, 20, 21, 24, 26)]

    def edit(x):
        i, c = r.randrange(len(x)), r.choice("abcé 한")
        return r.choice([x[:i] + x[i + 1 :], x[:i] + c + x[i:], x[:i] + c + x[i + 1 :], x]) or "a"

    table = [(d, "\n".join(edit(edit(r.choice(base))) for _ in range(6))) for d in range(60)] + [(900, "Copyright 2019"), (901, "Copyright 2018")]
    first = {}
    for d, t in table:
        for p, x in enumerate(t.split("\n")):
            if x.strip():
                first.setdefault(x, (d, p))
    bad = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= least and _one_edit(a, b)}
    want = [(d, "\n".join(x for p, x in enumerate(t.split("\n")) if not x.strip() or (first[x] == (d, p) and x not in bad))) for d, t in table]
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert bad and _sorted(line_dedup.dedup_lines(df, least).select("doc_id", "text")) == sorted(want, key=str)
    if least == 0:
        monkeypatch.setattr(queries, "_read", lambda *_: df)
        got = {x.doc_id: x.kept_sha256 for x in queries.op10_line_dedup(spark, "").collect()}
        assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want} and got[901] == hashlib.sha256(b"").hexdigest()
