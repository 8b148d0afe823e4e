"""Toxicity by weak supervision (operator 6).

Voters are a fixed lexicon in groups, sentence patterns, and word stems that a bounded sample of labelled rows
shows to be rare in clean texts. A generative label model learns from all documents, labelled or not, how often each
voter fires in either class: documents are counted by which voters fire on them, and EM alternates their posteriors
with the voters' rates. The sampled labels are anchors, votes of a known accuracy on their rows, and all documents
together weigh as much as the anchors, so that no corpus is large enough to carry the classes off. The model measures
the voters' correlations given the class, and counts a bundle of correlated voters less. A linear classifier over
pattern counts is trained on the posteriors of the sampled rows and scores every whole text by the text alone.

Bounds (parameters): ``SAMPLE_ROWS`` labelled rows, taken by the hash of their identifier, and ``MAX_PATTERNS`` patterns;
the model sent to executors has so many numbers at most, and a task sends sums of so many voters (squared) back. Votes
and scores are a pass over all texts each; the votes are shuffled as counts.

Defined results: a null or empty text gets the score of a text without any pattern; labels that are null, missing or
of held-out rows are not learned from; a row labelled twice counts as toxic if any label says so; repeated rows are
documents of their own; without usable labels the lexicon votes alone; columns named ``held_out``, ``score`` or
``predicted`` are replaced; of empty tables no rows come.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threshmill.llm import shared

SAMPLE_ROWS = 8_000
MAX_PATTERNS = 500
THRESHOLD = 0.3
#: Rounds of EM, the log odds of an anchor's vote, and tasks that sum a round over the counted votes; one more adds their sums.
ROUNDS, ANCHOR, CORPUS_TASKS = 8, float(np.log(0.98 / 0.02)), 16
STEM_LENGTHS = (4, 5, 6)
#: Voters that hold whatever the sample shows: words by group (fixed values).
LEXICON = {
    "insult": "idiot idiots moron morons clown clowns loser losers imbecile fool fools jerk jerks dumbass retard retards".split(),
    "contempt": "pathetic worthless disgusting useless ridiculous despicable vile repulsive".split(),
    "filth": "trash garbage scum filth vermin parasite parasites pig pigs".split(),
    "mind": "stupid dumb brainless clueless idiotic moronic braindead".split(),
    "obscene": "fuck fucking fucker shit shitty bullshit bitch bastard asshole cunt dick whore slut".split(),
    "threat": "kys lynch gas exterminate".split(),
}
SENTENCES = {
    "second_person": re.compile(r"\byou(?:'re| are| r)?(?: all)?(?: a| an| such| so)? (?:fucking |complete |total |utter )?(?:idiot|moron|loser|clown|fool|scum|trash|pathetic|worthless|disgusting|stupid)", re.I),
    "wish_harm": re.compile(r"\b(?:go|please|hope you|should) (?:die|kill yourself|rot)\b", re.I),
    "silence": re.compile(r"\b(?:shut up|nobody likes you|get lost)\b", re.I),
}
#: Whether any sentence pattern hits, in one scan that stops at the letters they start with.
_ANY_SENTENCE = re.compile(r"\b(?=[yghpsn])(?:" + "|".join(p.pattern for p in SENTENCES.values()) + ")", re.I)
_WORD = re.compile(r"[^\W\d_]+")
#: Sampled rows that the driver works on at a time.
PART_ROWS = 512
HELD_OUT_MOD, HELD_OUT_REST = 4, 2


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_MOD == HELD_OUT_REST, F.lit(False))


def features_of(text: str) -> set[str]:
    """Words, and stems with a star, of a text in lower case."""
    words = set(_WORD.findall(text.lower()))
    return {w for w in words if len(w) > 2} | {w[:k] + "*" for w in words for k in STEM_LENGTHS if len(w) > k}


class Patterns:
    """Counts words and stems in a text in one pass of an Aho-Corasick automaton."""

    def __init__(self, names: list[str]):
        import ahocorasick

        self.names, by_text = names, {}
        for i, name in enumerate(names):
            by_text.setdefault(name.rstrip("*"), []).append((i, not name.endswith("*")))
        self.automaton = ahocorasick.Automaton()
        for text, kinds in by_text.items():
            self.automaton.add_word(text, (len(text), kinds))
        if by_text:
            self.automaton.make_automaton()
        self.empty = not by_text

    def counts(self, text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        if self.empty:
            return out
        low = text.lower()
        for end, (length, kinds) in self.automaton.iter(low):
            if end - length >= 0 and low[end - length].isalpha():
                continue
            for i, whole in kinds:
                follows = end + 1 < len(low) and low[end + 1].isalpha()
                if follows != whole:
                    out[i] = out.get(i, 0) + 1
        return out


def row_of(text: str, patterns: Patterns) -> np.ndarray:
    """A text's features: damped counts of the patterns, sentences hit, and how dense and how many hits there are."""
    n = len(patterns.names)
    x = np.zeros(n + len(SENTENCES) + 2)
    counts = patterns.counts(text)
    for i, c in counts.items():
        x[i] = min(3, c) / 3
    if _ANY_SENTENCE.search(text):
        for j, p in enumerate(SENTENCES.values()):
            x[n + j] = bool(p.search(text))
    hits = sum(counts.values()) or int(x[n:-2].sum())  # sentences count where no pattern hits
    if hits:
        x[-2] = min(1.0, np.log1p(hits) / 3)
        x[-1] = min(1.0, 400 * hits / (len(text) + 200) / 8)
    return x


def votes_of(x: np.ndarray) -> np.ndarray:
    """Which voters fire, from rows of features: the lexicon's groups, mined patterns, sentences."""
    groups = np.cumsum([0, *(len(w) for w in LEXICON.values())])
    return np.hstack([*((x[:, a:b] > 0).any(1)[:, None] for a, b in zip(groups, groups[1:])), x[:, groups[-1] : -2] > 0]).astype(np.uint8)


class LabelModel:
    """Naive Bayes over voters that fire or abstain, whose weights make up for correlations."""

    def __init__(self, prior: float, rates: np.ndarray, weight: np.ndarray):
        self.prior, self.rates, self.weight = prior, rates, weight  # rates: of firing in the clean and the toxic class

    def posterior(self, votes: np.ndarray, gold: np.ndarray | None = None) -> np.ndarray:
        """Of the toxic class, for each row of votes (0/1); gold: 0/1, or -1 for unknown."""
        on, off = np.log(self.rates[1] / self.rates[0]), np.log((1 - self.rates[1]) / (1 - self.rates[0]))
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * (on - off)) + (self.weight * off).sum()
        if gold is not None:
            logit = logit + np.where(gold < 0, 0.0, np.where(gold == 1, 1.0, -1.0)) * ANCHOR
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def sums(self, votes: np.ndarray, count: np.ndarray, gold: np.ndarray | None = None) -> np.ndarray:
        """What EM needs of rows that stand for ``count`` documents each: per class documents and firings, and the residuals' products."""
        toxic = self.posterior(votes, gold)
        residual = votes - toxic[:, None] * self.rates[1] - (1 - toxic)[:, None] * self.rates[0]
        shares = [np.concatenate([[s.sum()], s @ votes]) for s in (count * (1 - toxic), count * toxic)]
        return np.vstack([*shares, np.hstack([np.zeros((votes.shape[1], 1)), (residual * count[:, None]).T @ residual])])

    @staticmethod
    def of(sums: np.ndarray) -> LabelModel:
        clean, toxic, products = sums[0], sums[1], sums[2:, 1:]
        total = clean[0] + toxic[0]
        rates = np.stack([(clean[1:] + 0.05) / (clean[0] + 1), (toxic[1:] + 0.5) / (toxic[0] + 1)])
        spread = np.sqrt(np.diag(products) / total) + 1e-9
        weight = 1 / np.maximum(1, np.abs(products / total / spread[:, None] / spread).sum(1))
        return LabelModel(float(np.clip(toxic[0] / total, 0.005, 0.5)), np.clip(rates, 1e-9, 1 - 1e-9), weight)


def first_model(votes: np.ndarray, gold: np.ndarray) -> LabelModel:
    """From the anchors alone; without any, voters are taken to be right."""
    prior = float(np.clip(np.mean(gold[gold >= 0] == 1) if (gold >= 0).any() else 0.1, 0.01, 0.5))
    toxic = np.where(gold < 0, np.clip(prior + 0.8 * votes.any(1), 0, 0.9), np.where(gold == 1, 0.95, 0.05))
    share = lambda y: sum(y[a : a + PART_ROWS] @ votes[a : a + PART_ROWS].astype(float) for a in range(0, len(votes), PART_ROWS))
    rates = np.stack([(share(1 - toxic) + 0.05) / ((1 - toxic).sum() + 1), (share(toxic) + 0.5) / (toxic.sum() + 1)])
    return LabelModel(prior, np.clip(rates, 1e-9, 1 - 1e-9), np.ones(votes.shape[1]))


def label_model(votes: np.ndarray, gold: np.ndarray, corpus: Callable[[LabelModel], np.ndarray] | None = None, rounds: int = ROUNDS) -> LabelModel:
    """EM over the anchors' rows and a corpus, given as a function from a model to its sums over all documents."""
    model = first_model(votes, gold)
    for _ in range(rounds):
        sums = sum(model.sums(votes[a : a + PART_ROWS].astype(float), np.ones(len(votes[a : a + PART_ROWS])), gold[a : a + PART_ROWS]) for a in range(0, len(votes), PART_ROWS))
        if corpus is not None:
            more = corpus(model)
            documents = more[:2, 0].sum()
            sums = sums + more * min(1.0, len(votes) / max(1.0, documents))
        model = LabelModel.of(sums)
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the last weight is the intercept."""
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        slope, curve = penalty * w, np.diag(penalty)
        for a in range(0, len(x), PART_ROWS):
            x1 = np.hstack([x[a : a + PART_ROWS].astype(float), np.ones((len(x[a : a + PART_ROWS]), 1))])
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
            slope = slope + x1.T @ (p - target[a : a + PART_ROWS])
            curve = curve + (x1 * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x1
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """(patterns, weights) from a bounded sample of the labelled rows that are not held out."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    known = labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
    taken = known.orderBy(F.xxhash64(id_col), id_col).limit(sample_rows)  # so many rows at most: safe to broadcast
    rows = docs.select(F.col(id_col), shared.text_or_empty(text_col).alias("text")).join(F.broadcast(taken), id_col).select("toxic", "text")
    rows = shared.staged(spark, rows, shared.work_dir(spark, "toxicity"))

    def count(batches):
        for batch in batches:
            hits: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in {(t, y) for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist())}:
                hits[int(toxic == 1)].update(features_of(text))
            names = [*(hits[0].keys() | hits[1].keys())]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([hits[1][n] for n in names], pa.int64()), pa.array([hits[0][n] for n in names], pa.int64())], ["name", "toxic", "clean"])

    n_toxic, n_clean = rows.agg(F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0)), F.coalesce(F.sum((F.col("toxic") != 1).cast("long")), F.lit(0))).first()
    fixed = [w for words in LEXICON.values() for w in words]
    found: list[str] = []
    if n_toxic:
        rate = lambda c, n: (F.col(c) + 0.5) / F.lit(float(n + 1))
        stats = rows.mapInArrow(shared.frugal(count), "name string, toxic long, clean long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        odds = F.log(rate("toxic", n_toxic) / rate("clean", n_clean))
        stats = stats.filter((F.col("toxic") >= max(4, round(0.01 * n_toxic))) & (odds > float(np.log(8))))
        found = [r.name for r in stats.orderBy((odds * F.col("toxic")).desc(), "name").limit(MAX_PATTERNS - len(fixed)).collect()]
    names = fixed + [n for n in found if n not in set(fixed)]

    def vectors(batches):
        patterns = Patterns(names)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([row_of(t, patterns).astype(np.float32).tobytes() for t in texts], pa.binary()), batch.column("toxic").cast(pa.int32())], ["x", "toxic"])

    sample = rows.mapInArrow(shared.frugal(vectors), "x binary, toxic int").collect()  # ``sample_rows`` rows of bounded length
    width = len(names) + len(SENTENCES) + 2
    x = np.zeros((len(sample), width), np.float32)
    for row, r in zip(x, sample):
        row[:] = np.frombuffer(r.x, np.float32)
    gold = np.array([r.toxic for r in sample], int)
    del sample
    # Rows that show each fixed voter once keep it alive where the sample has no such word; where there is hardly a
    # sample, empty rows keep toxicity rare.
    blank = max(1, 10 * len(fixed) - int((gold == 0).sum()))
    voters = len(fixed) + len(SENTENCES)
    known_words = np.zeros((voters + blank, width), np.float32)
    for i in range(voters):
        known_words[i, -2] = known_words[i, -1] = 1 / 3
        if i < len(fixed):
            known_words[i, i] = 1 / 3
        else:
            known_words[i, len(names) + i - len(fixed)] = 1
    x = np.vstack([x, known_words])
    gold = np.concatenate([gold, np.full(voters, 1), np.zeros(blank, int)])
    counted = count_votes(docs, names, text_col)

    def corpus(model: LabelModel) -> np.ndarray:
        def run(batches):
            total = None
            for batch in batches:
                votes = np.unpackbits(np.frombuffer(b"".join(batch.column("votes").to_pylist()), np.uint8).reshape(batch.num_rows, -1), axis=1)[:, : len(model.weight)].astype(float)
                own = model.sums(votes, batch.column("n").to_numpy().astype(float))
                total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        def add(batches):
            total = np.zeros(shape)
            for batch in batches:
                for own in batch.column("sums").to_pylist():
                    total += np.frombuffer(own, np.float64).reshape(shape)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        shape = (len(model.weight) + 2, len(model.weight) + 1)
        sums = counted.coalesce(CORPUS_TASKS).mapInArrow(shared.frugal(run), "sums binary").repartition(1)  # as many rows as tasks
        found = sums.mapInArrow(shared.frugal(add), "sums binary").collect()
        return np.frombuffer(found[0].sums, np.float64).reshape(shape) if found else np.zeros(shape)

    votes = votes_of(x)
    model = label_model(votes, gold, corpus)
    posterior = np.concatenate([model.posterior(votes[a : a + PART_ROWS].astype(float), gold[a : a + PART_ROWS]) for a in range(0, len(votes), PART_ROWS)])
    return names, fit_linear(x, posterior)


def count_votes(docs: DataFrame, names: list[str], text_col: str = "text") -> DataFrame:
    """How many documents (n) each set of voters (votes, packed bits) fires on: all documents, in one pass."""
    spark = docs.sparkSession

    def run(batches):
        patterns = Patterns(names)
        for batch in batches:
            found: Counter[bytes] = Counter()
            for a in range(0, batch.num_rows, 128):
                rows = np.array([row_of(t, patterns) for t in batch.column("text")[a : a + 128].to_pylist()])
                found.update(map(bytes, np.packbits(votes_of(rows), axis=1)))
            yield pa.RecordBatch.from_arrays([pa.array([*found.keys()], pa.binary()), pa.array([*found.values()], pa.int64())], ["votes", "n"])

    counted = docs.select(shared.text_or_empty(text_col).alias("text")).mapInArrow(shared.frugal(run), "votes binary, n long")
    return shared.staged(spark, counted.groupBy("votes").agg(F.sum("n").alias("n")), shared.work_dir(spark, "toxicity-votes"))


def score(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """Adds ``held_out``, ``score`` and ``predicted`` to documents, under a prefix if there is one."""
    shared.small_batches(docs.sparkSession)
    names, weights = model

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns = Patterns(names)
        for texts in batches:
            logits = [float(row_of(t, patterns) @ weights[:-1] + weights[-1]) for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))

    scored = docs.withColumn(f"{prefix}held_out", held_out(id_col)).withColumn(f"{prefix}score", run(shared.text_or_empty(text_col)))
    return scored.withColumn(f"{prefix}predicted", (F.col(f"{prefix}score") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: a score of every whole text of ``documents``."""
    docs = shared.table(spark, sf_dir, "documents")
    model = train(docs, shared.table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "held_out", "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    model = train(docs, shared.table(spark, sf_dir, "labels"))
    return score(docs, model, prefix="_toxicity_").filter("_toxicity_predicted = 0").select(*docs.columns)
