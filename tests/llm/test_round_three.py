"""Whitening, periodic runs and graph search against brute force, with nulls, ties, repeats, long rows and empty tables."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import graph_search, line_dedup, periodic_runs, queries, whitening
from tests.conftest import SF

VECTORS = "vec_id long, embedding array<double>, label int, dim int, n long, id long, x string, v string, shard int, h1 long"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "x", "v", 5, 6) for i, v in rows], VECTORS)


# Whitening

def _reference(xs, components=4, scale=256):
    """(n, S, e, trace, axes) of the distinct integer rows, covariances in fractions."""
    fit = sorted(set(map(tuple, xs)))
    n, dim = len(fit), len(fit[0])
    s = [sum(r[j] for r in fit) for j in range(dim)]
    cov = np.array([[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in fit), n**3)) for j in range(dim)] for i in range(dim)])
    e, u = np.linalg.eigh(cov)
    return n, s, e[::-1][:components], np.trace(cov), u[:, ::-1][:, :components]


def test_whitening_equals_fractions(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=6) * [9, 4, 2, 1, 0.5, 0.25] + 1000]) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [rows[3], (None, rows[4][1])]
    bad = [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6), (2004, [1.0] * 5 + [float("inf")]), (2005, [float("-inf")] + [1.0] * 5)]
    got = whitening.whiten(_vectors(spark, rows + bad)).collect()
    xs = [[int(np.floor(c * 256)) for c in v] for _, v in rows]
    n, s, e, trace, axes = _reference(xs)
    assert n == 200 and len(got) == 4 * len(rows) and {g.n for g in got} == {n} and {g.component for g in got} == {1, 2, 3, 4}
    assert len({g.identity_error for g in got}) == 1 and got[0].identity_error < 1e-9
    sign = None
    for k in range(4):
        own = {g.vec_id: g for g in got if g.component == k + 1}
        assert all(abs(g.explained - e[k] / trace) < 1e-9 for g in own.values())
        z = {i: float(sum(Fraction(x[j] * n - s[j], n) * Fraction(axes[j, k]) for j in range(6))) / np.sqrt(e[k]) for (i, _), x in zip(rows, xs, strict=True)}
        sign = 1 if own[0].whitened * z[0] > 0 else -1
        assert all(abs(sign * g.whitened - z[i]) < 1e-9 for i, g in own.items())
        assert all(int(own[i].deviation) == sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)) for (i, _), x in zip(rows, xs, strict=True))


def test_whitening_of_large_small_and_flat_vectors(spark):
    """Entries near and beyond 64 bits, several lengths, one distinct vector, too few dimensions."""
    r = np.random.default_rng(3)
    big = [(i, [float(x) for x in r.normal(size=3) * 10.0 ** r.integers(0, 16, 3)]) for i in range(60)]
    ends = [(100, [1e300, -1e300, 0.0]), (101, [-1e300, 1e300, 5.0])]
    flat = [(200 + i, [1.0, 2.0]) for i in range(5)]
    line = [(300 + i, [float(i), 2.0 * i, 7.0, 0.0]) for i in range(9)]
    got = whitening.whiten(_vectors(spark, big + ends + flat + line)).collect()
    top = (1 << 63) - 1
    xs = [[min(max(int(np.floor(c * 256)), -top - 1), top) if abs(c) < 1e200 else (top if c > 0 else -top - 1) for c in v] for _, v in big + ends]
    n, s, e, trace, _ = _reference(xs)
    three = {(g.vec_id, g.component): g for g in got if g.vec_id < 200}
    assert n == 62 and {k[1] for k in three} <= {1, 2, 3} and all(abs(three[0, k + 1].explained - e[k] / trace) <= 1e-9 for k in range(len({k[1] for k in three})))
    for (i, _), x in zip(big + ends, xs, strict=True):
        exact = sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True))
        assert three[i, 1].deviation is None if exact >= 10**38 else int(three[i, 1].deviation) == exact
    assert not [g for g in got if 200 <= g.vec_id < 300]  # no variance, no axis
    assert {(g.vec_id, g.component) for g in got if g.vec_id >= 300} == {(300 + i, 1) for i in range(9)}  # rank one
    assert whitening.whiten(_vectors(spark, [])).collect() == [] and whitening.whiten(_vectors(spark, [(1, None)])).collect() == []


def test_exact_parts():
    r = np.random.default_rng(4)
    for size in (3, 1 << 19, 1 << 30, 1 << 45, 1 << 61, (1 << 63) - 1):
        x = r.integers(-size, size, (70, 4), endpoint=True)
        s, c = whitening.scatter_of(x)
        o = x.astype(object)
        assert (s == o.sum(0)).all() and (c == o.T.dot(o)).all()
        limbs = whitening._limbs(c.ravel())
        assert (sum(v.astype(object) << (whitening.LIMB * k) for k, v in enumerate(limbs)) == c.ravel()).all()
        assert (whitening.unpacked(whitening.packed(x)) == x).all()
    assert whitening.packed(np.array([[-128, 127]]))[0][0] == 2 and whitening.packed(np.array([[-127, 127]]))[0][0] == 1


def test_whitening_joined_under_salts(spark, monkeypatch):
    rows = _vectors(spark, [(i, [float(i % 7), float(i % 5), float(i)]) for i in range(70)] + [(100 + i, [float(i), float(i * i)]) for i in range(9)])
    key = lambda df: {(r.vec_id, r.component, int(r.deviation)): r.whitened for r in df.collect()}
    want = key(whitening.whiten(rows))
    monkeypatch.setattr(whitening, "MOST_BROADCAST", 0)
    assert key(whitening.whiten(rows)) == pytest.approx(want) and len(want) == 70 * 3 + 9 * 2


def test_op11(spark):
    got = queries.op11_embedding_whitening(spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint" and got.count() == 4 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert got.agg(F.max("identity_error")).first()[0] < 1e-9


# Periodic runs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _runs(words, least=24, exponent=3):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda x: (x[0], x[2]))


def _texts():
    r = random.Random(11)
    out = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "a b " * 12, "A a " * 40, "é x " * 30, "\x1c \x85 " * 20, "x" * 3000]
    for _ in range(80):
        w = [r.choice("abcdefgh"[: r.choice([1, 2, 3, 8])]) for _ in range(r.choice([0, 5, 24, 90]))]
        for _ in range(r.randint(0, 3)):
            block = [r.choice(["a", "b", "xx", "한국"]) for _ in range(r.choice([1, 2, 7, 9, 20]))]
            at = r.randint(0, len(w))
            w[at:at] = block * r.choice([2, 3, 4, 12]) + block[: r.randint(0, len(block))]
        out.append(r.choice([" ", "\n", " \t "]).join(w))
    return out


def _collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("unit", [1 << 31, 40])
def test_runs_equal_brute_force(spark, unit):
    """A small unit cuts most texts into ranges of shifts."""
    texts = _texts()
    ids = [None, 7, 7, *range(8, 5 + len(texts))]
    rows = list(zip(ids, texts, strict=True)) + [(7, texts[12]), (7, texts[12])]
    docs = spark.createDataFrame([(i, t, "k", 1, "r") for i, t in rows], "doc_id long, text string, h1 string, first int, runs string")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], None if r.best is None else tuple(r.best), r.text) for r in periodic_runs.periodic_runs(docs, unit=unit).collect()), key=str)
    want = []
    for i, t in rows:
        w = [] if t is None else WORD.findall(t.encode())
        runs = _runs(w)
        want.append((i, len(w), runs, min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None), _collapsed(w, runs)))
    assert got == sorted(want, key=str) and sum(len(w[2]) for w in want) > 30
    assert periodic_runs.periodic_runs(docs.filter("false")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, exponent=2)


def test_ties_and_divisors_of_a_period():
    words = [b"a", b"b"] * 12 + [b"c"] + [b"x", b"y"] * 12 + [b"d"] + [b"z"] * 24
    found = periodic_runs.sorted_runs(periodic_runs.scan([periodic_runs.word_ids(words)], 1, len(words) // 3, 24, 3)[0])
    assert found == [(0, 24, 2), (25, 24, 2), (50, 24, 1)]  # never a multiple of the period
    nested = ([b"a"] * 30 + [b"b"]) * 3
    assert (0, 93, 31) in _runs(nested) and periodic_runs.sorted_runs(periodic_runs.scan([periodic_runs.word_ids(nested)], 1, 31, 24, 3)[0]) == _runs(nested)


def test_op12_equals_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = [] if d.text is None else WORD.findall(d.text.encode())
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if n > 1500:
            continue  # brute force takes long
        runs = _runs(w)
        some += len(runs) > 0
        b = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
        assert got[d.doc_id] == (len(runs), *b, 1000 * b[1] // b[2] if runs else None, hashlib.sha256(lines).hexdigest(), hashlib.sha256(_collapsed(w, runs).encode()).hexdigest())
    assert some > 5


# Graph search

def _brute(rows, query_ids, k=10):
    out = {}
    for q in query_ids:
        v = np.array(next(x for i, x in rows if i == q))
        near = sorted({(float(np.sqrt(((np.array(x) - v) ** 2).sum())), i) for i, x in rows if i != q and len(x) == len(v)})[:k]
        out[q] = [(i, s) for s, i in near]
    return out


@pytest.mark.parametrize("shard", [8192, 150])
def test_nearest_equals_brute_force(spark, shard):
    """Clusters, copies of one vector by the hundred, two lengths, unusable rows; one shard and several."""
    r = np.random.default_rng(5)
    heart = r.normal(size=(6, 16)) * 4
    rows = [(i, [float(x) for x in heart[i % 6] + r.normal(size=16)]) for i in range(600)]
    rows += [(10_000 + i, rows[0][1]) for i in range(300)] + [(20_000 + i, [float(x) for x in r.normal(size=5)]) for i in range(7)]
    bad = [(1_000, None), (1_100, []), (1_200, [0.0] * 16), (1_300, [float("nan")] * 16), (1_400, [None] * 16), (None, rows[5][1])]
    df = _vectors(spark, [*rows, rows[0], *bad])
    got = {}
    for g in graph_search.nearest(df, df.filter("vec_id % 100 = 0"), shard=shard).orderBy("query_id", "rank").collect():
        got.setdefault(g.query_id, []).append((g.vec_id, g.score))
        assert g.rank == len(got[g.query_id])
    want = _brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert set(got) == set(want) and len(got[20_000]) == 6  # fewer candidates than 10
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hits >= 0.97
    assert got[0] == [(10_000 + i, 0.0) for i in range(10)] and got[10_000][:2] == [(0, 0.0), (10_001, 0.0)]
    for q, found in got.items():
        exact = dict(_brute(rows, [q], 10**6)[q])
        assert all(abs(s - exact[i]) < 1e-12 for i, s in found) and found == sorted(found, key=lambda x: (x[1], x[0]))
    assert graph_search.nearest(df.filter("false"), df).collect() == [] and graph_search.nearest(df, df.filter("false")).collect() == []


def test_recall_in_many_dimensions():
    """Random directions in 64 dimensions, where graphs find it hardest, and a dense cluster with few links out of it."""
    r = np.random.default_rng(6)
    x = r.normal(size=(3000, 64))
    x[:1000] = x[0] + r.normal(size=(1000, 64)) * 0.01
    small = graph_search._searchable(x)[0]
    links, starts = graph_search.build_graph(small, 32, 64, 1.2)
    full = np.vstack([links, np.full((1, links.shape[1]), len(x))])
    at = r.permutation(len(x))[:200]
    place, _ = graph_search.beam_search(small, (small * small).sum(1), full, starts, small[at], 192)
    far = ((x[at][:, None, :] - x[None]) ** 2).sum(2)
    true = np.argsort(far, 1)[:, :10]
    assert np.mean([len(set(p[:20].tolist()) & set(t.tolist())) / 10 for p, t in zip(place, true, strict=True)]) >= 0.95
    assert (links >= 0).all() and (links <= len(x)).all() and (links != np.arange(len(x))[:, None]).all()


def test_every_vector_is_reached():
    """Vectors of one direction prune one another; each can still be found from where searches start."""
    r = np.random.default_rng(7)
    x = np.vstack([np.outer(np.exp(r.uniform(0, 9, 300)), [1.0, 0.0]), r.normal(size=(300, 2)) * 1e-3, [[0.0, 1e6]]]).astype(np.float32)
    for n in (1, 2, 7, 300, len(x)):
        links, starts = graph_search.build_graph(x[:n], 3, 8, 1.0)
        seen, front = set(starts.tolist()), set(starts.tolist())
        while front:
            front = {p for f in front for p in links[f].tolist() if p < n} - seen
            seen |= front
        assert len(seen) == n


def test_prune_keeps_diverse_links():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [0, 1.3], [-5, 0]], np.float32)
    got = graph_search.robust_prune(x, (x * x).sum(1), np.array([0]), np.array([[5, 4, 3, 2, 1, 1, 0, -1]]), 4, 1.2)
    assert got.tolist() == [[1, 3, 5, 6]]  # 2 is covered by 1, 4 by 3; 6 fills up


def test_op13_recall(spark):
    got = {}
    for r in queries.op13_nearest_neighbours(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = _brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert set(got) == set(want) and np.mean([len(got[q] & {i for i, _ in want[q]}) / 10 for q in want]) >= 0.95


def test_lines_that_share_a_half(spark):
    """A half that a third of all lines have: each line's near copies are found, and keys meet by aggregates, not in one task's window."""
    r = random.Random(3)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    shared, lines = word(30), []
    for i in range(240):
        lines.append(shared + word(30) if i % 3 == 0 else word(r.choice([24, 59, 60])))
        if i % 8 == 0:
            at, old = r.randrange(len(lines[-1])), lines[-1]
            lines.append(r.choice([old[:at] + old[at + 1 :], old[:at] + "z" + old[at + 1 :], old[:at] + "z" + old[at:]]))
    docs = spark.createDataFrame([(i // 40, "\n".join(lines[i : i + 40])) for i in range(0, len(lines), 40)], "doc_id long, text string")
    got = {x.doc_id: x.n_removed for x in line_dedup.dedup_lines(docs).collect()}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return a == b
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]

    want = dict.fromkeys(got, 0)
    for j, line in enumerate(lines):
        want[j // 40] += any(near(line, x) for x in lines[:j])
    assert sum(want.values()) >= 30 and got == want
    halves = line_dedup._halves(F.col("line"), F.lit(0), None)
    rows = line_dedup._lines(docs).select("id", F.inline(F.transform(halves, lambda h: F.struct(h["key"].alias("key"), h["role"].alias("role")))))
    plan = line_dedup._met(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
