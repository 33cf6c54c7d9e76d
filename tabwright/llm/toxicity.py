"""Toxicity by weak supervision: many voters, a generative label model over their votes, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tabwright.llm.batches import slices, split_words, texts_of

# A lexicon of insults, each a voter, and patterns over whole texts, each a voter.
LEXICON = (
    "clown", "creep", "crap", "degenerate", "disgusting", "dumb", "fool", "freak", "garbage", "idiot", "imbecile", "jerk",
    "loser", "moron", "pathetic", "pig", "scum", "stupid", "trash", "vermin", "worthless",
)
PATTERNS = {"~shouting": "[A-Z]{4,} [A-Z]{4,} [A-Z]{4,}", "~bangs": "!{3,}", "~you": "(?i)you(?:'re| are) (?:a|an|all|such) "}
LETTERS = re.compile(r"[^\W\d_]+")
SHORTEST, LONGEST = 3, 8
# Bounds of the fit: labelled rows it looks at, voters it keeps, and the evidence (G squared) a found voter needs.
SAMPLE_ROWS, MOST_VOTERS, LEAST_EVIDENCE = 20_000, 1024, 25.0
# Evidence (G squared within the classes) that two voters depend on each other.
LEAST_DEPENDENCE = 20.0
HELD = 1_000_000
THRESHOLD = 0.3


def word_patterns(word: str) -> list[str]:
    """Voters a word may belong to: itself and its beginnings of 3 to 8 letters, of each run of letters in it."""
    out = []
    for part in LETTERS.findall(word.lower()):
        out.append(f"={part}")
        out += [f"^{part[:k]}" for k in range(SHORTEST, min(LONGEST, len(part)) + 1)]
    return out


def text_patterns(texts: pa.Array) -> dict[str, np.ndarray]:
    return {name: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for name, p in PATTERNS.items()}


@dataclass
class Voters:
    """Names of the voters in their order."""

    names: list[str]

    def votes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, voter) of every vote, each once, sorted."""
        index = {name: k for k, name in enumerate(self.names)}
        offsets, codes, words = split_words(texts)
        hits = [[index[p] for p in word_patterns(w) if p in index] for w in words.to_pylist()]
        many = np.fromiter(map(len, hits), np.int64, len(hits))
        flat = np.array([v for h in hits for v in h], np.int64)
        starts = np.cumsum(many) - many
        at = np.flatnonzero(many[codes]) if len(codes) else np.zeros(0, np.int64)
        rows = np.searchsorted(offsets, at, side="right") - 1
        own = codes[at] if len(at) else np.zeros(0, np.int64)
        voter = np.concatenate([np.zeros(0, np.int64), *(flat[starts[c]:starts[c] + many[c]] for c in own.tolist())])
        keys = [np.repeat(rows, many[own]) * len(self.names) + voter]
        for name, seen in text_patterns(texts).items():
            if name in index:
                keys.append(np.flatnonzero(seen) * len(self.names) + index[name])
        both = np.unique(np.concatenate(keys))
        return both // max(1, len(self.names)), both % max(1, len(self.names))


def find_voters(sample: DataFrame) -> Voters:
    """The voters: the lexicon, the text patterns, and the words and beginnings of words that speak for the label in the
    sample (text, toxic), by their G squared; at most ``MOST_VOTERS``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {0: Counter(), 1: Counter()}

        def rows() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([counts[k][n] for n in names], pa.int64()) for k in (1, 0))],
                                              names=["name", "pos", "neg"])

        for batch in (s for b in batches for s in slices(b, 0, 4_000_000)):
            texts, labels = texts_of(batch.column(0)), batch.column(1).to_pylist()
            offsets, codes, words = split_words(texts)
            own = [word_patterns(w) for w in words.to_pylist()]
            for row, label in enumerate(labels):
                counts[label].update({p for c in set(codes[offsets[row]:offsets[row + 1]].tolist()) for p in own[c]})
            for name, seen in text_patterns(texts).items():
                for row in np.flatnonzero(seen).tolist():
                    counts[labels[row]][name] += 1
            if len(counts[0]) + len(counts[1]) > HELD:
                yield rows()
                counts = {0: Counter(), 1: Counter()}
        yield rows()

    totals = sample.agg(F.sum("toxic").alias("p"), F.count("*").alias("n")).first()
    n = max(1, totals["n"])
    share = min(max((totals["p"] or 0) / n, 1 / (n + 1)), n / (n + 1))
    summed = sample.select("text", "toxic").mapInArrow(work, "name string, pos long, neg long").groupBy("name").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    size = F.col("pos") + F.col("neg")

    def term(count, part: float):
        return F.when(count > 0, 2 * count * F.log(count / (size * part))).otherwise(0.0)

    found = (
        summed.withColumn("evidence", term(F.col("pos"), share) + term(F.col("neg"), 1 - share))
        .where((F.col("pos") > size * share) & (F.col("evidence") >= LEAST_EVIDENCE))
        .orderBy(F.desc("evidence"), "name").limit(MOST_VOTERS - len(LEXICON) - len(PATTERNS)).select("name").collect()
    )
    fixed = [f"={w}" for w in LEXICON] + list(PATTERNS)
    return Voters(fixed + [r["name"] for r in found if r["name"] not in fixed])


# ---- label model --------------------------------------------------------------------------------------------------

@dataclass
class LabelModel:
    """A generative model of votes: a hidden class, and for every voter its rate in each class, given the voter it hangs on.

    ``rates[c, v, j]`` is the chance that voter j fires in class c when its parent does not (v = 0) or does (v = 1) fire;
    voters without a parent (-1) have the same rate twice.
    """

    prior: float
    parents: np.ndarray
    rates: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of class 1 against class 0 for each row of votes."""
        on, off = np.log(self.rates[1] / self.rates[0]), np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        child = np.flatnonzero(self.parents >= 0)
        own = on[0] - off[0]
        above = np.zeros(len(own))
        np.add.at(above, self.parents[child], (off[1] - off[0])[child])
        both = (on[1] - off[1] - on[0] + off[0])[child]
        out = np.empty(len(votes))
        for part in range(0, len(votes), 2000):
            x = votes[part:part + 2000]
            out[part:part + 2000] = x @ (own + above) + (x[:, child] * x[:, self.parents[child]]) @ both
        return out + off[0].sum() + np.log(self.prior / (1 - self.prior))


def dependencies(votes: np.ndarray, shares: list[np.ndarray]) -> np.ndarray:
    """For each voter the one it hangs on (-1: none): a forest of the strongest correlations within the classes.

    ``shares`` are the rows' weights in each class. Two voters are joined by their mutual information given the class,
    strongest first, as long as its evidence (twice the rows times the information) passes ``LEAST_DEPENDENCE``.
    """
    voters = votes.shape[1]
    evidence = np.zeros((voters, voters))
    for share in shares:
        n = share.sum() + 1.0
        both = votes.T @ (votes * share[:, None])
        one = np.diag(both)
        for i_fires in (1, 0):
            for j_fires in (1, 0):
                a, b = (one if i_fires else n - one)[:, None], (one if j_fires else n - one)[None, :]
                joint = both if i_fires and j_fires else one[:, None] - both if i_fires else one[None, :] - both if j_fires else n - one[:, None] - one[None, :] + both
                joint = np.maximum(joint, 1e-9)
                evidence += 2 * joint * np.log(np.maximum(joint * n / np.maximum(a * b, 1e-9), 1e-12))
    i, j = np.triu_indices(voters, 1)
    strong = np.flatnonzero(evidence[i, j] >= LEAST_DEPENDENCE)
    strong = strong[np.argsort(-evidence[i[strong], j[strong]], kind="stable")]
    tree, near = list(range(voters)), [[] for _ in range(voters)]

    def root(k: int) -> int:
        while tree[k] != k:
            tree[k] = tree[tree[k]]
            k = tree[k]
        return k

    for x, y in zip(i[strong].tolist(), j[strong].tolist()):
        if root(x) != root(y):
            tree[root(x)] = root(y)
            near[x].append(y)
            near[y].append(x)
    parents, seen = np.full(voters, -1), set()
    for start in range(voters):
        line = [start] if start not in seen else []
        seen.update(line)
        for k in line:
            for other in near[k]:
                if other not in seen:
                    seen.add(other)
                    parents[other] = k
                    line.append(other)
    return parents


def label_model(votes: np.ndarray, weights: np.ndarray, start: np.ndarray, known: np.ndarray | None = None, rounds: int = 4,
                trees: int = 2) -> tuple[np.ndarray, LabelModel]:
    """Posterior of class 1 for each row of votes (rows x voters, 0 or 1), and the model.

    Expectation maximisation from ``start``. In each of ``trees`` turns the voters' dependencies are estimated anew from the posterior,
    then rates and posterior are improved ``rounds`` times. Rows marked ``known`` count in the rates with their ``start`` (the
    label) instead of their posterior; they keep the classes in their places. The posterior itself, of every row, comes from votes alone.
    """
    known = np.zeros(len(votes), bool) if known is None else known
    q = start
    if known.any() and not known.all():  # what the known rows say of the others, before the others have a say
        _, first = label_model(votes[known], weights[known], start[known], np.ones(known.sum(), bool), 1, 1)
        q = 1 / (1 + np.exp(-np.clip(first.log_odds(votes), -30, 30)))
    voters = np.arange(votes.shape[1])
    for _ in range(trees):
        held_to = np.where(known, start, q)
        parents = dependencies(votes, [weights * (1 - held_to), weights * held_to])
        held = parents >= 0
        above = votes[:, np.where(held, parents, 0)] * held
        for _ in range(rounds):
            rates = np.empty((2, 2, len(voters)))
            held_to = np.where(known, start, q)
            for c, share in enumerate((weights * (1 - held_to), weights * held_to)):
                whole = (votes.T @ share + (0.02 if c else 0.01)) / (share.sum() + 1.0)
                fired, total = (votes * above).T @ share, above.T @ share
                rates[c, 1] = (fired + 2 * whole) / (total + 2)
                rates[c, 0] = (votes.T @ share - fired + 2 * whole) / (share.sum() - total + 2)
                rates[c, 0, ~held] = rates[c, 1, ~held] = whole[~held]
            rates = np.clip(rates, 1e-6, 1 - 1e-6)
            prior = (weights @ held_to + 0.5) / (weights.sum() + 1)
            model = LabelModel(prior, parents, rates)
            q = 1 / (1 + np.exp(-np.clip(model.log_odds(votes), -30, 30)))
    return q, model


def calibrated(log_odds: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Posteriors made honest by the known labels: a logistic curve of two numbers over the model's log odds, rising."""
    x = np.clip(log_odds, -15, 15) / 15
    a, b = 5.0, 0.0
    for _ in range(4000):  # gradient steps below the inverse of the curvature, which is at most weights / 2
        wrong = weights * (1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))) - labels)
        a = max(0.1, a - 2 * (wrong @ x + 0.01 * (a - 5)) / weights.sum())
        b -= 2 * (wrong.sum() + 0.01 * b) / weights.sum()
    return 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))


def fit_linear(votes: np.ndarray, target: np.ndarray, weights: np.ndarray, ridge: float = 0.05, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps, with ridge on all but the intercept."""
    total = weights.sum()
    step = 4.0 / (((votes.sum(axis=1) + 1) * weights).sum() / total * max(1.0, votes.sum(axis=1).max() ** 0.5) + ridge)
    w, b = np.zeros(votes.shape[1]), float(np.log((weights @ target + 1) / (weights @ (1 - target) + 1)))
    last_w, last_b = w, b
    for k in range(rounds):
        push = k / (k + 3)
        ahead_w, ahead_b = w + push * (w - last_w), b + push * (b - last_b)
        p = 1 / (1 + np.exp(-np.clip(votes @ ahead_w + ahead_b, -30, 30)))
        wrong = weights * (p - target)
        last_w, last_b = w, b
        w = ahead_w - step * (votes.T @ wrong / total + ridge / total * ahead_w)
        b = ahead_b - step * wrong.sum() / total
    return w, b


@dataclass
class ToxicityModel:
    voters: Voters
    weights: np.ndarray
    intercept: float

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Scores of texts, and how many voters fired."""
        rows, voter = self.voters.votes(texts)
        logit = self.intercept + np.bincount(rows, self.weights[voter], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), np.bincount(rows, minlength=len(texts))


def fit(sample: DataFrame) -> ToxicityModel:
    """Fit on rows (text, toxic). Their number must be bounded by the caller; votes, not texts, reach the driver."""
    voters = find_voters(sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 0)):
            rows, voter = voters.votes(texts_of(batch.column(0)))
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            lists = [voter[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(lists, pa.list_(pa.int32()))], names=["toxic", "known", "votes"])

    # the label model sees the labels of half the texts only, chosen by their hash
    halves = sample.select("text", F.col("toxic").cast("int").alias("toxic"), (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("known"))
    cast = halves.mapInArrow(work, "toxic int, known boolean, votes array<int>")
    keys = ["toxic", "known", "votes"]
    rows = cast.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys).collect()  # at most a row per sampled row
    votes = np.zeros((len(rows), len(voters.names)))
    for k, r in enumerate(rows):
        votes[k, r["votes"]] = 1.0
    labels, n, known = np.array([r["toxic"] for r in rows], int), np.array([r["n"] for r in rows], float), np.array([r["known"] for r in rows], bool)
    if not len(rows):
        return ToxicityModel(voters, np.where(np.arange(len(voters.names)) < len(LEXICON), 4.0, 0.5), -3.0)
    stems = votes[:, [k for k, name in enumerate(voters.names) if name[0] in "=~"]].sum(axis=1)
    _, model = label_model(votes, n, np.where(known, labels, np.where(stems > 0, 0.9, 0.02)), known)
    q = calibrated(model.log_odds(votes), labels, n)
    weights, intercept = fit_linear(votes, q, n)
    unseen = (votes.sum(axis=0) == 0) & (np.arange(len(voters.names)) < len(LEXICON))
    return ToxicityModel(voters, np.where(unseen, 2.0, weights), intercept)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents of the training part, those whose id hashes lowest."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    known = known.where("toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # at most ``rows`` ids


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted, n_votes.

    Labels are learned from at most ``sample_rows`` labelled rows whose crc32(doc_id as text) mod 4 is not 2; language,
    source, id and label are no inputs of a score. Scoring reads every whole text in place, without a shuffle. Null and
    empty texts score as texts without votes; a null id is not held out; repeated rows stay; without labels the lexicon
    alone scores; an empty table gives no rows; other columns are not read.
    """
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1)):
            score, fired = model.score(texts_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(fired)], names=["doc_id", "score", "n_votes"])

    scored = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(work, "doc_id long, score double, n_votes long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "n_votes")
