"""Vectors by collision counts, ranked search by sketches, collocations: against brute force, on odd rows and forced limits."""

import collections
import itertools
import math
import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tabwright.llm import collisions, collocations as phrases, lexical
from tabwright.llm.collisions import calibrated, candidate_pairs, cells, collision_rate, near_vectors, reached, spanning
from tabwright.llm.collocations import collocations, collocations_sql
from tabwright.llm.hat_trie import HatTrie, packed, unpacked
from tabwright.llm.lexical import Queries, search, search_sql, sketches
from tests.llm.test_exact import ODD
from tests.oracle_check import compare

NEW = ["op11_embedding_dedup", "op12_lexical_search", "op13_collocations"]


@pytest.mark.parametrize("key", NEW)
def test_query_equals_sql(spark, small_folder, small_db, key):
    assert compare(corpus_pipeline.QUERIES[key](spark, small_folder), small_db, corpus_pipeline.SQL[key]) is None


# ---- vectors ------------------------------------------------------------------------------------------------------

def family(seed, n=700, size=24):
    """Random vectors, chains and balls of near ones, copies, scaled copies; a third of a label is one ball."""
    draw = np.random.default_rng(seed)
    rows = [(draw.normal(0, 1, size), int(draw.integers(0, 3))) for _ in range(n // 2)]
    ball = draw.normal(0, 1, size)
    rows += [(ball + draw.normal(0, 0.03, size), 0) for _ in range(n // 4)]
    step = draw.normal(0, 1, size)
    for _ in range(n // 8):  # neighbours are near, ends are not
        step = step + draw.normal(0, 0.1, size)
        rows.append((step, 1))
    rows += [(rows[int(draw.integers(0, len(rows)))][0] * 2.0 ** int(draw.integers(-3, 4)), int(draw.integers(0, 3))) for _ in range(n // 8)]
    return [(k, v.tolist(), label) for k, (v, label) in enumerate(rows)]


def brute(rows, limit=0.98):
    links, root = collections.Counter(), {i: i for i, _, _ in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    good = [(i, np.array(v, float) / max(map(abs, v)), label) for i, v, label in rows
            if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for (i, v, a), (j, w, b) in itertools.combinations(good, 2):
        if a == b and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= limit:
            links[i] += 1
            links[j] += 1
            x, y = sorted((top(i), top(j)))
            root[y] = x
    return {i: (links[i], top(i), top(i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("options", [{}, dict(cell=8, chunk=10), dict(cell=30, chunk=25, projections=36, groups=4)])
def test_near_vectors_equal_brute_force(spark, options):
    rows = family(1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df, **options).collect()}
    assert got == brute(rows)


def test_odd_vectors(spark):
    odd = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [1.0, float("nan")], 0), (6, [float("inf"), 1.0], 0),
           (7, [1.0, 0.0], 0), (8, [1.0, -0.0], 0), (9, [1e300, 0.0], 0), (10, [1e-300, 1e-310], 0), (11, [1.0, 0.0, 0.0], 0), (12, [1.0, 0.0], None),
           (13, [1.0, 0.0], 1), (14, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(odd, "vec_id long, embedding array<double>, label int")
    df = df.selectExpr("*", "'mine' AS node", "7 AS copies", "'x' AS cell", "1 AS n_links", "true AS kept")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert got == brute(odd) and got[8][:2] == (3, 7) and got[9][:2] == (3, 7)
    twice = spark.createDataFrame([(5, [1.0, 0.0], 0), (5, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)], df.select("vec_id", "embedding", "label").schema)
    assert sorted(near_vectors(twice).collect(), key=str) == [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)]
    assert near_vectors(df.limit(0)).count() == 0
    floats = df.select("vec_id", "label", df.embedding.cast("array<float>").alias("embedding")).where("vec_id IN (7, 8, 13)")
    assert {r.vec_id: r.n_links for r in near_vectors(floats).collect()} == {7: 1, 8: 1, 13: 0}


def test_calibrated_window_gives_the_recall():
    """Pairs exactly at the limit, random in space, reach the count as often as promised."""
    window, least = calibrated(0.98, 0.97, 24, 3)
    assert reached(collision_rate(window, math.sqrt(0.04)), 24, 24 - least) == pytest.approx(0.97, abs=1e-6)
    draw = np.random.default_rng(7)
    a = collisions.unit(draw.normal(size=(20_000, 32)))
    side = collisions.unit(draw.normal(size=a.shape))
    side = collisions.unit(side - np.einsum("ij,ij->i", a, side)[:, None] * a)
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * side
    toward = collisions.directions(32, 24)
    hit = (np.abs((a - b) @ toward) <= window).sum(axis=1) >= least
    assert abs(hit.mean() - 0.97) < 0.015
    assert calibrated(0.98, 0.999)[0] > window


def test_cells_and_windows_find_every_colliding_pair():
    draw = np.random.default_rng(8)
    values, window = draw.normal(0, 1, (300, 3)), 0.4
    at, away, place = cells(values, window)
    home = {r: tuple(p) for r, v, p in zip(at, away, place) if not v}
    seen = collections.Counter()
    keys = collections.defaultdict(lambda: ([], []))
    for r, v, p in zip(at.tolist(), away.tolist(), place.tolist()):
        keys[tuple(p)][int(v)].append(r)
    for homes, visits in keys.values():
        seen.update(tuple(sorted(p)) for p in itertools.combinations(homes, 2))
        seen.update(tuple(sorted(p)) for p in itertools.product(homes, visits))
    for i, j in itertools.combinations(range(300), 2):
        if (np.abs(values[i] - values[j]) <= window).all():
            assert seen[i, j] == 1, (home[i], home[j])
    assert max(seen.values()) == 1
    line = draw.normal(0, 1, 200)
    found = {tuple(sorted(p)) for a, b in candidate_pairs(line, None, 0.1) for p in zip(a.tolist(), b.tolist())}
    assert found == {(i, j) for i, j in itertools.combinations(range(200), 2) if abs(line[i] - line[j]) <= 0.1}


def test_spanning_links_keep_components():
    draw = np.random.default_rng(9)
    a, b = draw.integers(0, 500, 800), draw.integers(0, 500, 800)

    def parts(x, y):
        root = list(range(500))
        for i, j in zip(x.tolist(), y.tolist()):
            low, high = sorted((root[i], root[j]))
            root = [low if r == high else r for r in root]
        return root

    chosen = spanning(a, b)
    assert len(chosen) < 500 and parts(a[chosen], b[chosen]) == parts(a, b)


# ---- ranked search --------------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top=10):
    bags = [(i, collections.Counter(terms(t))) for i, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for (i, bag), n in zip(bags, sizes):
            m = 100 - 75 + 75 * n * n_docs // n_terms if n else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms(text) if bag[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def made_up_docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Äther", "naïve", "x9"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k, " ".join(rng.choices(words, weights, k=rng.choice([3, 30, 200])))) for k in range(n)]


@pytest.mark.parametrize("options", [{}, dict(coordinates=7, queries_at_once=3), dict(top=3, coordinates=64)])
def test_search_equals_brute_force(spark, corpus, options, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 20_000)
    docs = made_up_docs(1, 400) + ODD + [(900, "w1 w2 w3")] * 3
    rng = random.Random(2)
    items = [(k, t) for k, (_, t) in enumerate(rng.sample(docs[:400], 12))] + [(50, None), (51, ""), (52, "unheard of"), (53, "w0"), (53, "w0"), (None, "w9 W9 w10")]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS rank", "'q' AS query")
    got = [tuple(r) for r in search(corpus(docs), table, **options).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == ranked(docs, items, options.get("top", 10))


def test_search_of_nothing(spark, corpus):
    items = spark.createDataFrame([("a", "w1")], "item_id string, text string")
    assert search(corpus([]), items).count() == 0 and search(corpus([(1, "w1")]), items.limit(0)).count() == 0
    assert [tuple(r) for r in search(corpus([(1, "w1"), (2, None)]), items).collect()] == [("a", 1, 1, search(corpus([(1, "w1")]), items).first().score)]


def test_sketches_bound_scores_and_most_documents_are_not_scored(corpus):
    docs = made_up_docs(4, 3000)
    texts = lexical.pa.array([t for _, t in docs], lexical.pa.large_string())
    queries = Queries([" ".join(docs[k][1].split()[:20]) for k in range(0, 3000, 300)])
    sizes, rows, codes, counts, words = lexical.term_counts(texts)
    n_docs, n_terms = int((sizes > 0).sum()), int(sizes.sum())
    queries.weigh(n_docs, collections.Counter(queries.numbered(words)[codes].tolist()))
    weights = queries.matrix(256)
    best = lexical.Best(10, 10)
    scored = lexical.search_slice(best, queries, weights, np.arange(3000), texts, n_docs, n_terms)
    assert scored < 10 * 3000 / 3
    bounds = sketches(rows, lexical.folded(words, 256)[codes], lexical.impacts(counts, sizes[rows], n_docs, n_terms), 3000, 256) @ weights
    assert (bounds[best.doc, best.query] * lexical.SLACK >= best.score).all()
    one = lexical.Best(10, 10)
    for part in range(0, 3000, 100):  # slice after slice gives the same
        lexical.search_slice(one, queries, weights, np.arange(part, part + 100), texts.slice(part, 100), n_docs, n_terms)
    assert one.doc.tolist() == best.doc.tolist() and one.score.tolist() == best.score.tolist()


# ---- collocations -----------------------------------------------------------------------------------------------------

def strongest(rows, least=10, drop=50, top=2000):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            counts.update((lang or "und", tuple(w[k:k + n])) for n in (1, 2, 3) for k in range(len(w) - n + 1))
    out = collections.defaultdict(list)
    for (lang, g), a in counts.items():
        if len(g) < 2 or a < least:
            continue
        score, cut = min((10**6 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g)))
        if len(g) == 2 and any(c >= least and 100 * c >= drop * a for (x, t), c in LONGER(counts, lang, g)):
            continue
        out[lang].append((-score, -a, " ".join(g).encode(), counts[lang, g[:cut]], counts[lang, g[cut:]], cut))
    return sorted((lang, k + 1, p.decode(), -a, left, right, totals[lang], -s, cut)
                  for lang, rows in out.items() for k, (s, a, p, left, right, cut) in enumerate(sorted(rows)[:top]))


def LONGER(counts, lang, g):
    return [(key, c) for key, c in counts.items() if key[0] == lang and len(key[1]) == 3 and g in (key[1][:2], key[1][1:])]


def chatter(seed, n):
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(9)] + ["Zürich", "a\x1cb", "日本"]
    rows = [(" ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n", "!"]) for _ in range(rng.choice([1, 20, 60]))), rng.choice(["en", "de", None])) for _ in range(n)]
    return rows + [("New York City. " * 30, "en"), ("new york", "en"), (None, "en"), ("", None), ("ja\tja ja ja " * 40, "de"), ("Only once here", "xx")]


@pytest.mark.parametrize("options", [{}, dict(entries=200, words=30), dict(top=7), dict(least=30, drop_percent=90)])
def test_collocations_equal_brute_force(corpus, options, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 3000)
    monkeypatch.setattr(phrases, "TEXT_BYTES", 100)
    rows = chatter(1, 400)
    docs = corpus([(k, *r) for k, r in enumerate(rows)]).selectExpr("*", "'x' AS phrase", "1 AS f", "2 AS k")
    got = sorted(tuple(r) for r in collocations(docs, **options).collect())
    assert got == strongest(rows, options.get("least", 10), options.get("drop_percent", 50), options.get("top", 2000)) and len(got) >= 2


def test_collocations_of_nothing(corpus):
    assert collocations(corpus([])).count() == 0 and collocations(corpus([(1, None), (2, "one two. one")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([(9 * 10**11, 10**12, 10**12 - 1)], "a long, l long, r long")
    got = counts.select(phrases._score("a", "l", "r").alias("s")).first().s
    assert got == 10**6 * (9 * 10**11) ** 2 // (10**12 * (10**12 - 1))


def test_trie_counts_bursts_and_spills():
    draw = np.random.default_rng(5)
    trie, want, got = HatTrie(burst=64), collections.Counter(), collections.Counter()
    for turn in range(12):
        ids = [np.minimum(draw.geometric(0.02, 3000), 2**20) for _ in range(3)]
        keys = packed(ids[:1 + turn % 3])
        want.update(keys.tolist())
        trie.add(keys)
        assert max(map(len, trie.containers)) <= 64 and trie.lows == sorted(trie.lows)
        for run, counts in trie.spill(0.4) if turn % 4 == 3 else ():
            assert (np.diff(run) > 0).all()
            got.update(dict(zip(run.tolist(), counts.tolist())))
    for run, counts in trie.spill():
        got.update(dict(zip(run.tolist(), counts.tolist())))
    assert got == want and trie.entries == 0
    three = unpacked(packed([np.array([5, 0]), np.array([7, 2])]))
    assert [t.tolist() for t in three] == [[5, 0], [7, 2], [-1, -1]]


def test_the_sql_agrees_with_brute_force():
    """The oracle itself, on odd rows that the given tables do not have."""
    rows = chatter(3, 60)
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(k, *r) for k, r in enumerate(rows)])
    assert sorted(db.execute(collocations_sql()).fetchall()) == strongest(rows)
    db.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    items = [(k, rows[k][0]) for k in range(8)] + [(20, None)]
    db.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(db.execute(search_sql()).fetchall(), key=str) == ranked([(k, t) for k, (t, _) in enumerate(rows)], items)
