"""Queries against their SQL, and operators against brute force where the first tests use properties."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docweave.llm import embedding_dedup, exact_dedup, language, line_dedup, mixing, ngram_join, packing, queries, shared, url_filter
from tests.conftest import SF, rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), db.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("dim", [64, 384])
def test_recall_at_the_limit(dim):
    """Pairs of cosine 0.9 exactly share a bucket."""
    r = np.random.default_rng(dim)
    a = r.normal(size=(600, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = r.normal(size=a.shape)
    o -= (o * a).sum(1)[:, None] * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * o / np.linalg.norm(o, axis=1)[:, None]
    x, y = (embedding_dedup.bucket_keys(v, 6, 2, 4, seed=dim) for v in (a, b))
    found = [bool(set(p) & set(q)) for p, q in zip(x, y, strict=True)]
    assert np.mean(found) >= 0.97


def test_equal_vectors_in_cut_buckets(spark):
    """Copies of vectors, near vectors and pairs at 0.895 to 0.905, in buckets of several chunks, against brute force."""
    r = np.random.default_rng(3)
    base = r.normal(size=64)
    near = [base + r.normal(size=64) * 0.3 for _ in range(50)]
    edge = [base * 0.9 / np.linalg.norm(base) + s * np.sqrt(1 - 0.81) * (o - (o @ base) / (base @ base) * base) / np.linalg.norm(o - (o @ base) / (base @ base) * base) for o, s in zip(r.normal(size=(30, 64)), [0.98, 0.995, 1.03] * 10, strict=True)]
    x = [base] * 60 + near + [near[0]] * 40 + edge + list(r.normal(size=(40, 64)))
    order = r.permutation(len(x))
    x = [x[i] for i in order]
    rows = [(i, [float(z) for z in v]) for i, v in enumerate(x)]
    u = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    cos = u @ u.T
    adj = cos >= 0.9
    np.fill_diagonal(adj, False)
    low = np.arange(len(x))
    for _ in range(20):
        low = np.minimum(low, np.where(adj, low[None, :], len(x)).min(1))
    df = spark.createDataFrame([*rows, rows[0], (None, rows[0][1])], "vec_id long, embedding array<double>")
    for chunk in (2048, 16):
        got = {g.vec_id: g for g in embedding_dedup.near_vectors(df, chunk=chunk).collect()}
        n = np.array([got[i].n_links for i in range(len(x))])
        assert (n <= adj.sum(1)).all() and n.sum() >= 0.97 * adj.sum()
        assert np.mean([got[i].component_id == low[i] for i in range(len(x))]) >= 0.97
        same = [i for i, v in enumerate(x) if v is base]
        assert len({(got[i].n_links, got[i].component_id) for i in same}) == 1 and got[same[0]].n_links >= len(same) - 1


def test_vectors_of_one_id(spark):
    """An id of two vectors joins what each is linked with."""
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    df = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, [0.0, 0.0, 1.0, 0.0])], "vec_id long, embedding array<double>")
    got = {(g.vec_id, g.n_links, g.component_id) for g in embedding_dedup.near_vectors(df).collect()}
    assert got == {(1, 1, 1), (2, 2, 1), (3, 1, 1), (4, 0, 4)}


def _reputation(counts, z=1.645):
    """host -> (rate, low) of host -> (n, k), by loops over hosts; what a host is shrunk to leaves its own labels out."""
    two = set(url_filter.TWO_LABELS)

    def names(host):
        x = host.split(".")
        suffix = 2 if ".".join(x[-2:]) in two else 1
        return ".".join(x[-suffix:]), ".".join(x[-suffix - 1 :])

    levels = [defaultdict(lambda: [0, 0]) for _ in range(3)]
    up = {}
    for host, (n, k) in counts.items():
        suffix, domain = names(host)
        up[host], up[domain, 1] = domain, suffix
        for level, key in zip(levels, ("", suffix, domain), strict=True):
            level[key][0] += n
            level[key][1] += k
    every, suffixes, domains = levels

    def spread(children, parent):
        extra = pairs = 0.0
        for c, (n, k) in children.items():
            if n:
                pn, pk = parent(c)
                m = pk / pn
                extra += n * (k / n - m) ** 2 - m * (1 - m)
                pairs += m * (1 - m) * (n - 1)
        return min(max((extra + url_filter.WEIGHT * url_filter.SPREAD) / (pairs + url_filter.WEIGHT), 0.001), 0.9)

    def post(n, k, m, v, rho):
        own = m * (1 - m)
        s = max(own / (v + rho * own) - 1, url_filter.LEAST_STRENGTH)
        m = (s * m + k) / (s + n)
        return m, m * (1 - m) / (s + n + 1)

    rho = [spread(suffixes, lambda c: every[""]), spread(domains, lambda c: suffixes[up[c, 1]]), spread(counts, lambda c: domains[up[c]])]
    out = {}
    for host, own in counts.items():
        domain, suffix = domains[up[host]], suffixes[up[up[host], 1]]
        n, k = (a - b for a, b in zip(every[""], suffix, strict=True))
        m = (k + 0.5) / (n + 1)
        v = m * (1 - m) / (n + 2)
        for (n, k), (less_n, less_k), r in zip((suffix, domain, own), (domain, own, (0, 0)), rho, strict=True):
            m, v = post(n - less_n, k - less_k, m, v, r)
        out[host] = (m, max(0.0, m - z * v**0.5))
    return out


def test_host_reputation_equals_brute_force(spark):
    r = random.Random(7)
    hosts = [f"{a}{b}" for b in ("one.org", "two.org", "shop.co.uk", "x.co.kr", "net") for a in ("", "a.", "b.", "c.d.")] + ["localhost", ""]
    bad = {h: r.random() ** 3 for h in hosts}
    pages = [(i, f"http://{r.choice(hosts)}/p" if i % 50 else None) for i in range(900)]
    labels = [(i, r.choice([0, 1]) if r.random() < bad[(u or "http:///").split("/")[2]] else 1, 0) for i, u in pages if r.random() < 0.5] + [(None, 0, 0)]
    counts = {}
    graded = {i: q == 0 for i, q, _ in labels if i is not None}
    for i, u in pages:
        h = u.split("/")[2] if u else ""
        n, k = counts.get(h, (0, 0))
        counts[h] = (n + (i in graded), k + graded.get(i, False))
    want = _reputation(counts)
    got = url_filter.host_reputation(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {g.host for g in got} == set(want)
    for g in got:
        assert (g.n, g.k) == counts[g.host] and g.rate == pytest.approx(want[g.host][0], abs=1e-9) and g.low == pytest.approx(want[g.host][1], abs=1e-9)


def _above(a, b, limit):
    """P(rate > limit) of a beta distribution, by sums over fine steps of ln(p / (1 - p))."""
    t = np.linspace(-60 / min(a, 1), 60 / min(b, 1), 2_000_001) + np.log(a / b)
    ln = -a * np.logaddexp(0, -t) - b * np.logaddexp(0, t)
    w = np.exp(ln - ln.max())
    return w[t > np.log(limit / (1 - limit))].sum() / w.sum()


def test_beta_tail_equals_integration(spark):
    cases = [(a, b, x) for a, b in ((1, 1), (4, 1), (0.3, 2.2), (7.5, 0.4), (60, 55), (505, 519), (900, 124), (20, 980)) for x in (0.1, 0.5, 0.9)]
    rows = spark.createDataFrame([(a / (a + b), a * b / ((a + b) ** 2 * (a + b + 1))) for a, b, _ in cases[::3]], "m double, v double")
    got = rows.select(*(url_filter.beta_above(F.col("m"), F.col("v"), x).alias(str(x)) for x in (0.1, 0.5, 0.9))).collect()
    for i, (a, b, x) in enumerate(cases):
        assert got[i // 3][i % 3] == pytest.approx(_above(a, b, x), abs=2e-4)
    assert got[0]["0.5"] == pytest.approx(0.5, abs=1e-9) and got[1]["0.5"] == pytest.approx(1 - 0.5**4, abs=1e-9)


def test_blocked_by_the_posterior_quantile(spark):
    """With a flat posterior of k bad labels the rate is above one half with probability 1 - 2**-(k + 1): 0.95 from four on."""
    beta = lambda a, b: (f"{a},{b}", 0, 0, a / (a + b), 0.0, 1.0, a * b / ((a + b) ** 2 * (a + b + 1)))
    rows = spark.createDataFrame([beta(4, 1), beta(5, 1), beta(600, 500), beta(2, 90)], "host string, n long, k long, rate double, low double, high double, v double")
    assert {r.host for r in url_filter.blocked_hosts(rows, 0.5, 1.645).collect()} == {"5,1", "600,500"}


def test_one_label_blocks_no_other_host(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/"), (3, "http://c.edu/"), (4, "http://d.a.org/")], "page_id long, url string")
    one = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert {g.verdict for g in url_filter.filter_urls(pages, one).filter("page_id > 1").collect()} == {"allow"}
    # A domain whose hosts are all bad blocks a host of it without labels.
    many = spark.createDataFrame([(i, f"http://h{i % 20}.bad.org/") for i in range(200)] + [(1000 + i, f"http://h{i}.good{i % 9}.org/") for i in range(200)] + [(5000, "http://new.bad.org/"), (5001, "http://new.good1.org/")], "page_id long, url string")
    seen = spark.createDataFrame([(i, 0, 0) for i in range(200)] + [(1000 + i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    got = {g.page_id: g.verdict for g in url_filter.filter_urls(many, seen).collect()}
    assert got[5000] == "block" and got[5001] == "allow"


def test_taken_words_equal_brute_force(spark):
    """Each document's words taken, block by block, from the shard's order and its permutation of blocks."""
    r = random.Random(1)
    docs = spark.createDataFrame([(i, "w " * r.choice([0, 1, 5, 40, 200, 900]), r.choice(["a", "b", "c", None])) for i in range(300)], "doc_id long, text string, source string")
    options = {"shard": 5000, "share": 0.9}
    rows = mixing._placed(docs, **options).collect()
    got = {g.doc_id: g.taken for g in mixing.mix_sources(docs, **options).collect()}
    shards = defaultdict(list)
    for x in rows:
        shards[x.source, x.shard].append(x)
    assert len(shards) > 10 and any(x.passes for x in rows) and any(x.rest for x in rows)
    for own in shards.values():
        own.sort(key=lambda x: (x.start, x.end))
        words = [x.doc_id for x in own for _ in range(x.size)]
        first = own[0]
        assert [x.start for x in own] == [sum(y.size for y in own[:i]) for i in range(len(own))] and first.n == max(1, -(-len(words) // 64))
        taken = defaultdict(int)
        for copy in range(first.passes):
            for w in words:
                taken[w] += 1
        chosen = [b for b in range(first.n) if (b * first.prime + first.turn) % first.n < first.rest]
        assert len(chosen) == first.rest
        for b in chosen:
            for w in words[b * 64 : b * 64 + 64]:
                taken[w] += 1
        assert {x.doc_id: taken[x.doc_id] for x in own} == {x.doc_id: got[x.doc_id] for x in own}


CLASHES = ["_id", "_sha", "_times", "_copy", "_d", "_c", "_doc", "_crc", "_kept", "_lines", "_stays", "gone_id", "gone_text", "gone_hash", "taken_id", "kept_doc", "own_lines", "row", "node", "digest", "a.b", "x`y"]


@pytest.fixture(scope="module")
def clashing(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(9001, None, None, None), (9002, "", "en", "a"), (None, "the of and to in is that for it was", "en", None), (9003, "Line one\n" + "long " * 30000, "en", "a"), (9003, "other text of the same id here now", "en", "a")], d.schema)
    d = d.unionByName(odd)
    return d.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


def test_stages_with_clashing_columns_nulls_and_ties(spark, clashing):
    d, columns = clashing, clashing.columns
    ids = {x.doc_id for x in d.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, SF)
        assert out.columns == columns, name
        rows = out.collect()
        assert {x.doc_id for x in rows} <= ids and all(x["a.b"] == CLASHES.index("a.b") and x["_id"] == 0 for x in rows)
        assert stage(spark, d.filter("false"), SF).count() == 0
        if name == "language":
            assert not {9001, 9002} & {x.doc_id for x in rows} and None in {x.doc_id for x in rows}
        if name == "exact_dedup":
            texts = [exact_key(x.text) for x in rows]
            assert len(texts) == len(set(texts)) == len({exact_key(x.text) for x in d.collect()})
        if name == "ngram_join":
            assert [x.text for x in rows if x.doc_id == 9003] and sum(x.doc_id == 9003 for x in rows) == 2 and {9001, 9002} <= {x.doc_id for x in rows}
        if name == "mixing":
            assert {9001, 9002} <= {x.doc_id for x in rows}
    pieces = corpus_pipeline.STAGES[-1][1](spark, d, SF)
    assert pieces.filter("piece = 0").count() == d.count() and pieces.filter("doc_id = 9001").first().length == 1
    assert corpus_pipeline.STAGES[-1][1](spark, d.filter("false"), SF).count() == 0
    lines = line_dedup.dedup_lines(d)
    assert lines.columns == [*columns, "n_lines", "n_removed"] and lines.count() == d.count()


def exact_key(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_near_copies_of_one_id_are_judged_each(spark):
    """Rows of one doc_id in different groups: only the one that resembles a smaller id goes."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (5, base + " more"), (5, "quite another text that nothing else here resembles at all")]
    assert sorted(x.text[:5] for x in ngram_join.ngram_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == ["quite", base[:5]]


def test_null_ids_are_no_largest_id(spark):
    rows = [(2**63 - 1, "the same line of text here"), (None, "the same line of text here\nand this one"), (None, "another text\nand this one")]
    got = {(x.doc_id, x.text) for x in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2**63 - 1, rows[0][1]) in got and len(got) == 3 and sum((x[1] or "").count("and this one") for x in got) == 1


def test_sequences_hold_their_pieces_in_order(spark):
    rows = [(7, 0, 10, 0), (7, 1, 5, 10), (8, 0, 3, 0), (None, 0, 2, 3)]
    df = spark.createDataFrame([(a, b, 0, n, 0, s, o) for (a, b, n, o), s in zip(rows, (1, 1, 2, 2), strict=True)], "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    got = {x.sequence_id: (x.n_pieces, x.n_tokens, [(p.doc_id, p.piece) for p in x.pieces]) for x in packing.sequences(df).collect()}
    assert got == {1: (2, 15, [(7, 0), (7, 1)]), 2: (2, 5, [(8, 0), (None, 0)])} and packing.sequences(df.filter("false")).count() == 0


def test_many_tasks_strand_no_space(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    vocabulary = queries._vocabulary("word_bpe_49k.json")
    few, many = packing.pack(d.coalesce(1), vocabulary).toPandas(), packing.pack(d.repartition(40), vocabulary).toPandas()
    least = -(-few["length"].sum() // 4096)
    for got in (few, many):
        assert got["sequence_id"].nunique() <= least + 2
        for _, part in got.groupby("sequence_id"):
            part = part.sort_values("offset")
            assert part["offset"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]] and part["length"].sum() <= 4096


def test_more_than_255_languages():
    e = np.zeros((4, 300))
    e[:, 290] = 1.0
    assert language.viterbi(e, np.array([0]), np.array([4]), 8.0).tolist() == [290] * 4


def test_stored_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master, applicationId = "spark://host:7077", "x"

    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        shared.shared_path(Session)
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    shared.stored(spark.range(3))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == limit


def test_prediction_score_and_scripts(spark):
    """Script ranges narrow candidates: a text of a script that one language alone uses is that language's."""
    rows = [(i, t, k) for i in range(60) for t, k in ((f"привет мир как дела {i}", "ru"), (f"hello world how are you {i}", "en"))]
    docs = spark.createDataFrame([(j, t, k) for j, (_, t, k) in enumerate(rows)] + [(900, "совершенно", None), (901, "quux", None)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    ru, en = model.languages.index("ru"), model.languages.index("en")
    assert model.uses[4, ru] and not model.uses[4, en] and model.uses[1, en] and not model.uses[1, ru]
    got = {x.doc_id: x for x in language.identify(docs, model).collect()}
    assert got[900].lang_pred == "ru" and got[900].score > 0.99 and got[901].lang_pred == "en"
    emissions, letters, at, _ = language._emissions(model, ["совершенно".encode()])
    total = emissions.sum(0)
    odds = np.exp(np.minimum(total - total[ru], 50))
    assert got[900].score == pytest.approx(float(1 / odds.sum()), rel=1e-6)
