"""Operators that learn from the corpus: against brute force where there is one, else on held-out rows."""

import collections
import math
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from tabwright.llm import kneser_ney as kneser_ney_module
from tabwright.llm.kneser_ney import scored
from tabwright.llm.quality import FIELDS, bands, judge, keep_good, measures
from tabwright.llm.similarity import one_of_each_group
from tabwright.llm.toxicity import LabelModel, calibrated, fit_linear, label_model, score_toxicity
from tests.llm.test_exact import LOWER, ODD

SYLLABLES = "ka lo mi tu re sa no pe vi du".split()
WORDS = [a + b for a in SYLLABLES for b in SYLLABLES]


def prose(rng, words, syllables=SYLLABLES):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.choice([1, 2, 2, 3]))) for _ in range(words))


def kneser_ney(rows):
    """Interpolated modified Kneser-Ney over word pairs with plain dictionaries: summed logs of each (text, lang)."""

    def discounts(values):
        seen = collections.Counter(values)
        if not all(seen[k] for k in (1, 2, 3)):
            return {0: 0.0, 1: 0.5, 2: 1.0, 3: 1.5}
        y = seen[1] / (seen[1] + 2 * seen[2])
        return {0: 0.0} | {k: min(k, max(0.0, k - (k + 1) * y * seen[k + 1] / seen[k])) for k in (1, 2, 3)}

    texts = []
    for text, lang in rows:
        words = [(lang or "und", w) for w in re.findall(r"[^\x20\x09-\x0d]+", text or "")]
        texts.append(list(zip([(lang or "und", None), *words], words)))
    pairs = collections.Counter(p for t in texts for p in t)
    total, freed, follows = collections.Counter(), collections.Counter(), collections.Counter(w for _, w in pairs)
    d, e = discounts(pairs.values()), discounts(follows.values())
    for (v, _), c in pairs.items():
        total[v] += c
        freed[v] += d[min(c, 3)]
    rest = sum(e[min(n, 3)] for n in follows.values()) / max(1, len(pairs)) / (len(follows) + 1)
    single = {w: (n - e[min(n, 3)]) / len(pairs) + rest for w, n in follows.items()}
    log = {(v, w): math.log((c - d[min(c, 3)]) / total[v] + freed[v] / total[v] * single[w]) for (v, w), c in pairs.items()}
    return [(sum(log[p] for p in t), sum(math.log(single[w]) for _, w in t)) for t in texts]


@pytest.mark.parametrize("slice_bytes", [12_000_000, 700])
def test_kneser_ney_against_dictionaries(corpus, monkeypatch, slice_bytes):
    monkeypatch.setattr(kneser_ney_module, "SLICE_BYTES", slice_bytes)
    rng = random.Random(1)
    rows = [(k, prose(rng, rng.choice([1, 5, 60, 200])), rng.choice(["en", "de", None])) for k in range(60)]
    rows += [(*r, "en") for r in ODD] + [(100, rows[2][1], "en"), (101, "same " * 300, None)]
    want = collections.Counter((round(a, 2), round(b, 2)) for a, b in kneser_ney([(t, lang) for _, t, lang in rows]))
    found, _ = scored(corpus(rows), "text", "lang", [], 0, measures, FIELDS)
    got = collections.Counter((round(r.log_p, 2), round(r.log_single, 2)) for r in found.collect())
    near = [(p, q) for p, q in zip(sorted(want.elements()), sorted(got.elements()))]
    assert len(near) == len(rows) == sum(got.values())
    assert all(abs(a - b) < 0.02 + 1e-5 * abs(a) for p, q in near for a, b in zip(p, q))


def test_discounts_and_probabilities_add_up():
    import numpy as np
    from tabwright.llm.kneser_ney import discounts, pair_logs

    assert discounts(np.array([0, 5, 2, 1])).tolist() == [0.5, 1.0, 1.5]
    rng = np.random.default_rng(5)
    table = rng.poisson(0.8, (30, 40))
    table = table[:, table.sum(0) > 0]
    table = table[table.sum(1) > 0]
    v, w = np.nonzero(np.ones_like(table))
    seen = np.bincount(np.minimum(table[table > 0], 5), minlength=6)[1:5]
    d = discounts(seen)
    follows = (table > 0).sum(0)
    shares = np.array([*np.bincount(np.minimum(follows, 5), minlength=6)[1:5], len(follows), follows.sum()], float)
    total = table.sum(1)
    gamma = np.concatenate(([0.0], d))[np.minimum(table, 3)].sum(1) / total
    pair, single = pair_logs(v, w, table.ravel(), total, gamma, follows, d, shares)
    unknown = 1 - np.exp(single).sum()  # kept for one word never seen
    assert 0 < unknown < 0.05
    assert np.allclose(np.exp(pair).reshape(table.shape).sum(1) + gamma * unknown, 1)


def test_word_order_leaves_the_band(corpus):
    """A text of usual words in an order that no other text has is less probable than any text in the usual order."""
    rng = random.Random(12)
    order = {w: [rng.choice(WORDS) for _ in range(3)] for w in WORDS}

    def chain(n):
        out = [rng.choice(WORDS)]
        while len(out) < n:
            out.append(rng.choice(order[out[-1]]))
        return out

    rows = [(k, " ".join(chain(rng.choice([60, 150]))), "en") for k in range(300)]
    mixed = []
    for k in range(6):
        words = chain(400)
        rng.shuffle(words)
        mixed.append((1000 + k, " ".join(words), "en"))
    got = {r.doc_id: r for r in judge(corpus(rows + mixed)).collect()}
    assert all(got[i].kept for i, _, _ in rows)
    assert all(not got[i].kept and got[i].perplexity > got[i].upper for i, _, _ in mixed)
    assert all(got[i].single_lower <= got[i].single_perplexity <= got[i].single_upper for i, _, _ in mixed)


def test_bands_against_sorted_values(spark):
    rng = random.Random(6)
    rows = [(lang, n, rng.gauss(-7, 0.4) * n, rng.gauss(-9, 0.2) * n, rng.random() < 0.1) for lang in ("en", "de") for n in [rng.randrange(20, 300) for _ in range(150)]]
    rows += [("xx", 50, -300.0, -400.0, False), ("en", 0, 0.0, 0.0, True)]
    got = {r.lang: r for r in bands(spark.createDataFrame(rows, "lang string, n_words long, log_p double, log_single double, base_failed boolean")).collect()}
    assert set(got) == {"en", "de", "xx"}
    for lang in got:
        pair, single = (sorted(math.floor(abs(r[k] / r[1]) * 500 + 0.5) / -500 for r in rows if r[0] == lang and not r[4]) for k in (2, 3))

        def at(values, q):
            return next(x for k, x in enumerate(values) if (k + 1) / len(values) >= q)

        for name, values, quartile, behind in (("low", pair, 0.25, 0.1), ("single_low", single, 0.25, 0.1), ("single_high", single, 0.75, 0.9)):
            assert abs(got[lang][name] - at(values, quartile)) < 1e-9
            assert abs(got[lang][f"{name}_wide"] - 6 * max(0.1, abs(at(values, quartile) - at(values, behind)))) < 1e-6


def test_quality(corpus):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.choice([30, 80, 400])), "en") for k in range(200)]
    rows += [(1000, " ".join("".join(rng.choice("qxzwjkvb") for _ in range(9)) for _ in range(80)), "en"), (1001, "word " * 100, "en")]
    rows += [(*r, "en") for r in ODD] + [(1002, rows[0][1], None)]
    docs = corpus(rows)
    got = {(r.doc_id, r.n_words): r for r in judge(docs).collect()}
    for i, text, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
        windows = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        repeated = {k + j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        r = got[i, len(w)]
        assert (r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
    assert all(got[i, len(t.split())].kept for i, t, _ in rows[:200])
    assert not got[1000, 80].kept and got[1000, 80].single_perplexity > got[1000, 80].single_upper and not got[1001, 100].kept
    kept = collections.Counter(r.doc_id for r in keep_good(docs).collect())
    assert kept == collections.Counter(r.doc_id for r in got.values() if r.kept)
    assert judge(corpus([])).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_one_of_each_group(corpus):
    rng = random.Random(3)
    rows, clusters = [], []
    for c in range(25):
        base = prose(rng, 220).split()
        own = []
        for k in range(rng.choice([1, 2, 4])):
            words = list(base)
            for _ in range(3 if k else 0):
                words[rng.randrange(len(words))] = "changed"
            own.append(len(rows))
            rows.append((len(rows), " ".join(words)))
        clusters.append(own)
    rows += [(500, rows[0][1].upper()), (500, rows[0][1].upper()), (501, None), (502, ""), (None, "only once " * 6)]
    sets = {i: shingles(t) for i, t in rows if i is not None}
    for own in clusters:
        assert all(len(sets[own[0]] & sets[k]) >= 0.8 * len(sets[own[0]] | sets[k]) for k in own)
    kept = collections.Counter(r.doc_id for r in one_of_each_group(corpus(rows)).collect())
    assert kept == collections.Counter([own[0] for own in clusters] + [501, None])
    assert one_of_each_group(corpus([])).count() == 0


def test_large_group_of_near_copies(corpus, monkeypatch):
    from tabwright.llm import similarity

    monkeypatch.setattr(similarity, "CHUNK", 16)
    rng = random.Random(4)
    base = prose(rng, 300).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"new{k}"
        rows.append((k, " ".join(words)))
    assert [r.doc_id for r in one_of_each_group(corpus(rows)).collect()] == [0]


def test_groups_with_members_around_the_limit(corpus):
    """C and B are nearly equal; A is just similar enough to C and just not to B, and half of the estimates favour B."""
    rng = random.Random(11)
    texts = []
    for _ in range(24):
        c = prose(rng, 2000).split()
        places = rng.sample(range(20, 1990, 20), 45)
        a = [f"new{k}" if k in places[1:] else w for k, w in enumerate(c)]
        b = [f"odd{k}" if k == places[0] else w for k, w in enumerate(c)]
        texts += [" ".join(w) for w in (c, b, a)]
    for _ in range(5):
        family = [prose(rng, 220).split()]
        while len(family) < 16:
            words = list(rng.choice(family))
            for _ in range(rng.choice([4, 4, 5])):
                words[rng.randrange(220)] = f"new{rng.randrange(10**6)}"
            family.append(words)
        texts += [" ".join(w) for w in family]
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert sorted(r.doc_id for r in one_of_each_group(corpus(list(enumerate(texts)))).collect()) == sorted(set(root))


def test_crowded_band_keys_are_dealt_before_they_meet(spark):
    from tabwright.llm import similarity

    sizes = {1: 5000, 2: 64, 3: 2}
    rows = spark.createDataFrame([(k, node, n) for k, n in sizes.items() for node in range(n)], "key long, node long, n long")
    groups = similarity.dealt(rows, 64).groupBy("key", "group").count().collect()
    assert max(r["count"] for r in groups) < 128
    assert [sum(r["count"] for r in groups if r.key == k) for k in (1, 2, 3)] == [10000, 64, 2]
    joined = spark.createDataFrame([(node, 10**6) for node in range(4900)], "node long, root long")
    blocks = similarity.blocks_apart(rows, rows.where("key = 1").select("key"), joined, 64)
    apart = blocks.groupBy("block", "side").count().collect()
    assert max(r["count"] for r in apart) < 128 and sum(r["count"] for r in apart) == 5000 * 2 + 100 * 79
    left, right = blocks.where("side = 0").toDF("block", "s", "a", "ra"), blocks.where("side = 1").toDF("block", "t", "b", "rb")
    met = left.join(right, "block").where("ra <> rb").select(F.least("a", "b"), F.greatest("a", "b")).distinct().count()
    assert met == 100 * 4900 + 100 * 99 // 2


def test_toxicity_on_held_out_rows(spark, corpus):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(1500):
        words, toxic = prose(rng, 80).split(), rng.random() < 0.12
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words[rng.randrange(80)] = rng.choice(["idiot", "Moron,", "grubfel" + rng.choice(SYLLABLES), "grubfel" + rng.choice(SYLLABLES)])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    labelled = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(corpus(rows + ODD[:1]), labelled).collect() if r.doc_id != 1}
    truth = dict(labels)
    held = [i for i in got if got[i].held_out]
    assert 200 < len(held) < 600 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert sum(got[i].predicted == truth[i] for i in held) > 0.97 * len(held)
    assert sum(got[i].predicted for i in held if truth[i]) > 0.9 * sum(truth[i] for i in held)
    empty = score_toxicity(corpus([(1, None), (2, "you idiot"), (None, "")]), labelled.limit(0)).collect()
    assert sorted((r.doc_id or 0, r.predicted) for r in empty) == [(0, 0), (1, 0), (2, 1)]


def made_up_votes(seed, rows=6000):
    """Voters with known rates; voter 1 repeats voter 0 nine times of ten, voter 5 fires for another reason with voter 4."""
    draw = np.random.default_rng(seed)
    y = draw.random(rows) < 0.15
    rates = np.array([[0.55, 0.02], [0.0, 0.0], [0.45, 0.03], [0.5, 0.05], [0.3, 0.3], [0.0, 0.0], [0.35, 0.02], [0.4, 0.04]])
    votes = draw.random((rows, 8)) < np.where(y[:, None], rates[:, 0], rates[:, 1])
    votes[:, 1] = np.where(draw.random(rows) < 0.9, votes[:, 0], draw.random(rows) < 0.02)
    votes[:, 5] = np.where(draw.random(rows) < 0.95, votes[:, 4], draw.random(rows) < 0.3)
    return votes.astype(float), y, rates


def test_label_model_recovers_rates_and_correlations_without_labels():
    votes, y, rates = made_up_votes(1)
    start = np.where(votes[:, [0, 2, 3]].sum(axis=1) >= 2, 0.8, 0.1)
    q, model = label_model(votes, np.ones(len(votes)), start, rounds=40)
    assert abs(model.prior - y.mean()) < 0.05
    edges = {tuple(sorted((k, int(p)))) for k, p in enumerate(model.parents) if p >= 0}
    assert {(0, 1), (4, 5)} <= edges
    for k in (0, 2, 3, 6, 7):
        for c in (0, 1):
            fired = ((votes[:, k] * (q if c else 1 - q)).sum()) / (q if c else 1 - q).sum()
            assert abs(fired - rates[k, 1 - c]) < 0.12
    right = ((q > 0.5) == y).mean()
    assert right > 0.93 and right > ((votes.sum(axis=1) >= 3) == y).mean() and np.abs(q - y).mean() > 0.01
    # two voters that repeat each other count about once, two that fire for another reason not at all
    one = model.log_odds(np.eye(8)[[0]])[0] - model.log_odds(np.zeros((1, 8)))[0]
    two = model.log_odds(np.eye(8)[[0]] + np.eye(8)[[1]])[0] - model.log_odds(np.zeros((1, 8)))[0]
    assert 0 < one < two < 1.6 * abs(np.log(0.55 / 0.02)) + 1
    assert abs(model.log_odds(np.eye(8)[[4]] + np.eye(8)[[5]])[0] - model.log_odds(np.zeros((1, 8)))[0]) < 1


def test_label_model_odds_equal_the_product_of_rates():
    draw = np.random.default_rng(3)
    model = LabelModel(0.2, np.array([-1, 0, 1, -1]), draw.uniform(0.1, 0.9, (2, 2, 4)))
    model.rates[:, 1, [0, 3]] = model.rates[:, 0, [0, 3]]
    votes = np.array([[(k >> j) & 1 for j in range(4)] for k in range(16)], float)
    for row, got in zip(votes, model.log_odds(votes)):
        want = [p for p in (0.8, 0.2)]
        for c in (0, 1):
            for j in range(4):
                above = int(row[model.parents[j]]) if model.parents[j] >= 0 else 0
                want[c] *= model.rates[c, above, j] if row[j] else 1 - model.rates[c, above, j]
        assert got == pytest.approx(np.log(want[1] / want[0]))


def test_posterior_of_known_rows_comes_from_votes():
    votes, y, _ = made_up_votes(2, 3000)
    known = np.arange(len(y)) % 2 == 0
    wrong = y.copy()
    flipped = np.flatnonzero(known)[:30]
    wrong[flipped] = ~wrong[flipped]
    q, _ = label_model(votes, np.ones(len(y)), wrong.astype(float), known)
    assert ((q > 0.5) == y)[flipped].mean() > 0.8  # a wrong label does not become the posterior
    even = calibrated(np.log(np.clip(q, 1e-6, 1 - 1e-6) / (1 - np.clip(q, 1e-6, 1 - 1e-6))), y.astype(int), np.ones(len(y)))
    assert abs(even.mean() - y.mean()) < 0.02 and (np.diff(even[np.argsort(q)]) >= -1e-12).all()


def test_linear_fit_equals_the_optimum():
    draw = np.random.default_rng(4)
    x, n = (draw.random((400, 3)) < 0.4).astype(float), draw.integers(1, 5, 400).astype(float)
    target = 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.5] - 1)))
    w, b = fit_linear(x, target, n, rounds=4000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (n * (p - target)) + 0.05 * w).max() < 0.05 and abs((n * (p - target)).sum()) < 0.05


def test_pipeline_stages(spark, small_folder):
    docs = spark.read.parquet(f"{small_folder}/documents.parquet")
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["quality_rules", "line_dedup", "simhash_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), small_folder).columns == docs.columns, name
    packed = corpus_pipeline.run(spark, small_folder).toPandas()
    assert packed.groupby("doc_id").length.sum().eq(packed.groupby("doc_id").doc_tokens.first()).all()
    assert 0 < packed.doc_id.nunique() < 200


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_take_odd_rows(spark, corpus, small_folder, stage):
    rows = [(*r, None) for r in ODD]
    out = stage[1](spark, corpus(rows), small_folder)
    if stage[0] == "packing":
        assert {"doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"} <= set(out.columns) and out.count() >= len(rows)
        return
    assert out.columns == corpus(rows).columns
    left = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert not left - collections.Counter((i, t) for i, t, _ in rows)  # odd rows go or stay as they are
    if stage[0] in ("line_dedup", "decontamination"):
        assert sum(left.values()) >= len(rows) - 1


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_leave_other_columns_alone(spark, corpus, small_folder, stage):
    """Columns named like those an operator makes come back as they were; ``n_chars`` may be missing."""
    rng = random.Random(8)
    names = ["before", "n_lines", "n_removed", "n_runs", "runs", "row", "doc", "th", "_quality_lang", "_Quality_n_words", "text_", "node", "letters", "kept", "lang_"]
    page = "\n".join(prose(rng, 30) for _ in range(4))
    rows = [(k, f"{prose(rng, 60)}\n{page}" if k % 3 == 0 else prose(rng, 90)) for k in range(30)]
    docs = corpus(rows).drop("n_chars").selectExpr("*", *(f"concat('{n}', doc_id) AS `{n}`" for n in names))
    out = stage[1](spark, docs, small_folder)
    assert out.columns == docs.columns
    left = out.collect()
    assert len(left) >= 10 and all(r[n] == f"{n}{r.doc_id}" for r in left for n in names)
