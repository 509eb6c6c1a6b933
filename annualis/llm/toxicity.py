"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, reported speech, clause end). Five small
transducers read the symbols of a clause side by side; their product's last state names the kind
of clause, and its weight is that of the strongest term it holds. Insulting terms are words and
word beginnings, with log-odds learned from labels; the weights of the kinds of clause are fitted.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.session import stored

FIT_ROWS = 16_000  # bound of the labelled rows used for fitting
CANDIDATES = 50_000  # bound of the terms of toxic texts that are compared with clean ones
LEAST_RATIO, LEAST_ODDS = 30.0, 3.0
PUNCTUATION = ".,;:!?\"'()[]{}|«»“”„*#$%&-_…"
CACHE = 200_000
STEMS = (3, 4, 5, 6, 7, 8)

# Function words of English, German, French and Spanish, and seed terms.
TARGETS = "you your you're youre he she they his her their him them u ihr ihnen euch dich dir du sie er tu te vous ton ta tes il elle ils elles tú usted ustedes él ella ellos".split()
NEGATIONS = "not no never nobody isn't aren't don't won't isnt arent nicht kein keine keinen nie niemand pas jamais aucun aucune nadie nunca tampoco".split()
REPORTS = "said says called calls wrote writes quoted claimed according reported sagte sagt schrieb nannte laut dit disait écrit selon appelle dijo dice escribió según llamó".split()
THREATS = "kill hurt beat destroy burn shoot stab punch hang töten schlagen verletzen tuer frapper brûler matar golpear quemar".split()
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting dumb imbecile clown dummkopf arschloch connard imbécile salaud idiota estúpido imbécil".split()
PRIOR = 2.0  # weight of a seed term that the labels say nothing about

KINDS = ("insult", "aimed_insult", "threat", "aimed_threat", "denied", "reported")
# Prior means of the fitted weights: bias, length, strongest clause, then sum and rate for each kind of clause.
MEANS = np.array([-2.0, -0.3, 0.2, 0.5, 0.5, 0.5, 0.5, 0.1, 0.1, 0.2, 0.2, 0.2, 0.2, 0.05, 0.05])


def _machine(moves: dict[tuple[str, str], str], start: str) -> tuple[str, dict]:
    return start, moves


#: Each transducer: its first state and where a symbol leads; symbols not named leave it where it is.
INSULT = _machine({("none", "I"): "insult"}, "none")
THREAT = _machine({("none", "H"): "threat"}, "none")
TARGET = _machine({("none", "T"): "target"}, "none")
NEGATION = _machine({("plain", "N"): "open", ("open", "I"): "denied", ("open", "H"): "denied", ("plain", "I"): "stated",
                     ("plain", "H"): "stated", ("denied", "I"): "denied", ("denied", "H"): "denied"}, "plain")
REPORT = _machine({("direct", "R"): "reported"}, "direct")
SYMBOLS = "IHTNR"


def compose(*machines) -> tuple[tuple, dict]:
    """The product automaton: all reachable states and their moves."""
    start = tuple(m[0] for m in machines)
    moves, todo = {}, [start]
    seen = {start}
    while todo:
        state = todo.pop()
        for symbol in SYMBOLS:
            to = tuple(m[1].get((s, symbol), s) for s, m in zip(state, machines))
            moves[state, symbol] = to
            if to not in seen:
                seen.add(to)
                todo.append(to)
    return start, moves


START, MOVES = compose(INSULT, THREAT, TARGET, NEGATION, REPORT)


def kind_of(state: tuple) -> int:
    """Index of the kind of clause that ends in ``state``, or -1."""
    insult, threat, target, negation, report = state
    if insult == "none" and threat == "none":
        return -1
    if report == "reported":
        return KINDS.index("reported")
    if negation == "denied":
        return KINDS.index("denied")
    base = "threat" if threat == "threat" else "insult"
    return KINDS.index(f"aimed_{base}" if target == "target" else base)


END_KIND = {state: kind_of(state) for state, _ in MOVES}


@dataclass
class Lexicon:
    """Insulting words and word beginnings with their weights."""

    words: dict[str, float]
    stems: dict[str, float]
    cache: dict = field(default_factory=dict)

    def symbols(self, raw: str) -> tuple:
        """(symbol, weight) pairs of a chunk of text without white space; "B" ends a clause."""
        word = raw.strip(PUNCTUATION)
        out = []
        if any(c in raw for c in "\"“”„«»"):
            out.append(("R", 0.0))
        weight = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) >= n:
                weight = max(weight, self.stems.get(word[:n], 0.0))
        if weight > 0:
            out.append(("I", weight))
        elif word in _CLOSED:
            out.append((_CLOSED[word], PRIOR))
        if raw[-1:] in ".;:!?…" or raw == "but":
            out.append(("B", 0.0))
        return tuple(out)

    def lookup(self, chunks: list[str]):
        cache = self.cache
        for chunk in chunks:
            got = cache.get(chunk)
            if got is None:
                if len(cache) >= CACHE:
                    cache.clear()
                got = cache[chunk] = self.symbols(chunk)
            if got:
                yield from got


_CLOSED = {w: s for s, ws in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("H", THREATS)) for w in ws}


def clauses(text: str, lexicon: Lexicon):
    """(kind, weight) of each clause that holds an insult or a threat."""
    state, weight = START, 0.0
    for symbol, w in lexicon.lookup(text.lower().replace("\n", " ; ").split()):
        if symbol == "B":
            kind = END_KIND[state]
            if kind >= 0:
                yield kind, weight
            state, weight = START, 0.0
        else:
            state = MOVES[state, symbol]
            if symbol in "IH":
                weight = max(weight, w)
    if END_KIND[state] >= 0:
        yield END_KIND[state], weight


def features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """1, length, strongest clause, and for each kind of clause the sum of weights and that sum for 100 words."""
    text = text or ""
    words = len(text.split())
    top, total = 0.0, np.zeros(len(KINDS))
    for kind, weight in clauses(text, lexicon):
        top = max(top, weight)
        total[kind] += weight
    return np.concatenate([[1.0, math.log1p(words), top], np.log1p(total), 100 * total / (words + 20)])


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression towards ``MEANS``, by Newton's method with halved steps."""
    w = MEANS.copy()

    def loss(v):
        z = x @ v
        return np.logaddexp(0, z).sum() - y @ z + ridge / 2 * ((v - MEANS) ** 2).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * (w - MEANS)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text) -> float:
        z = float(features(text if isinstance(text, str) else None, self.lexicon) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _words(text: str | None) -> list[str]:
    return [w for c in (text or "").lower().split() if (w := c.strip(PUNCTUATION))]


def _term_counts(only: set[str] | None):
    """(term, seen, often, uses): texts with the term, texts with it twice or more, and all its uses.

    A term is a word ("=word") or the beginning of words ("<begin").
    """
    def run(frames):
        for frame in frames:
            counts: dict[str, list[int]] = {}
            for text in frame["text"]:
                own: Counter = Counter()
                for word, n in Counter(_words(text)).items():
                    for term in (f"={word}", *[f"<{word[:k]}" for k in STEMS if len(word) >= k]):
                        if only is None or term in only:
                            own[term] += n
                for term, n in own.items():
                    c = counts.setdefault(term, [0, 0, 0])
                    c[0] += 1
                    c[1] += n > 1
                    c[2] += n
            if counts:
                yield pd.DataFrame({"term": list(counts), **{k: [c[i] for c in counts.values()] for i, k in enumerate(("seen", "often", "uses"))}})

    return run


def _sum_terms(texts: DataFrame, only: set[str] | None = None) -> DataFrame:
    return (texts.select("text").mapInPandas(_term_counts(only), "term string, seen long, often long, uses long")
            .groupBy("term").agg(F.sum("seen").alias("seen"), F.sum("often").alias("often"), F.sum("uses").alias("uses")))


def likelihood_ratio(a, b, n_a: int, n_b: int):
    """G squared of ``a`` of ``n_a`` texts against ``b`` of ``n_b``; 0 where the first share is not the larger."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    share = (a + b) / (n_a + n_b)

    def part(seen, n, p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(seen > 0, seen * np.log(seen / (n * p)), 0.0)

    g = 2 * (part(a, n_a, share) + part(b, n_b, share) + part(n_a - a, n_a, 1 - share) + part(n_b - b, n_b, 1 - share))
    return np.where(a / n_a > b / n_b, g, 0.0)


def learn_terms(sample: DataFrame) -> Lexicon:
    """Terms that mark toxic texts of ``sample`` (text, words, toxic), weighted by the log-odds of their use.

    A term is taken if the likelihood ratio over texts (with it, or with it twice) is far above
    what the best of all terms reaches by chance.
    """
    totals = {r["toxic"]: r for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).collect()}
    seeds = {w: PRIOR for w in INSULTS}
    if len(totals) < 2:
        return Lexicon(seeds, {})
    toxic, clean = totals[1], totals[0]
    found = (_sum_terms(sample.filter("toxic = 1")).filter(F.col("seen") >= max(3, toxic["n"] // 200))
             .orderBy(F.desc("seen"), "term").limit(CANDIDATES).collect())
    others = {r["term"]: r for r in _sum_terms(sample.filter("toxic = 0"), {r["term"] for r in found}).collect()}
    none = {"seen": 0, "often": 0, "uses": 0}
    pairs = [(r, others.get(r["term"], none)) for r in found]
    ratio = np.maximum(*[likelihood_ratio([a[k] for a, _ in pairs], [b[k] for _, b in pairs], toxic["n"], clean["n"]) for k in ("seen", "often")])
    words, stems = dict(seeds), {}
    for (a, b), g in zip(pairs, ratio):
        odds = math.log((a["uses"] + 0.5) / (toxic["words"] + 1)) - math.log((b["uses"] + 0.5) / (clean["words"] + 1))
        if g >= LEAST_RATIO and odds >= LEAST_ODDS:
            (words if a["term"][0] == "=" else stems)[a["term"][1:]] = odds
    return Lexicon(words, stems)


def _sketch(frames):
    """Adds the number of words and the smallest hash of five words in a row, which near copies mostly share."""
    for frame in filter(len, frames):
        words = [_words(t) for t in frame["text"]]
        keys = [min((zlib.crc32(" ".join(w[k:k + 5]).encode()) for k in range(max(1, len(w) - 4))), default=0) for w in words]
        yield pd.DataFrame({"text": frame["text"].tolist(), "toxic": frame["toxic"].tolist(), "words": [len(w) for w in words], "sketch": keys})


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled texts, those with the smallest hash of doc_id.

    Labels that are null or not 0 or 1 are left out; near copies under one label mostly count once.
    With no usable label of either kind the seed terms and the prior weights score.
    """
    picked = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    sample = stored(docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(picked), "doc_id")
                    .select("text", "toxic").mapInPandas(_sketch, "text string, toxic int, words long, sketch long")
                    .groupBy("sketch", "toxic").agg(F.min(F.struct("text", "words")).alias("row")).select("row.*", "toxic"), "toxic-sample")
    lexicon = learn_terms(sample)

    def measure(frames):
        for frame in filter(len, frames):
            rows = [features(t, lexicon).tolist() for t in frame["text"]]
            yield pd.DataFrame({"x": rows, "y": frame["toxic"].astype("int")})

    got = sample.select("text", "toxic").mapInPandas(measure, "x array<double>, y int").collect()
    if len({r["y"] for r in got}) < 2:
        return Model(lexicon, MEANS.copy())
    x = np.array([r["x"] for r in got])
    return Model(lexicon, fit_weights(x, np.array([float(r["y"]) for r in got])))


def score_column(model: Model, text):
    """Column with the score of a text column; null and empty texts have no clause and get the bias alone."""
    lexicon, weights = Lexicon(model.lexicon.words, model.lexicon.stems), model.weights

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        own = Model(lexicon, weights)
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    return run(text)


def held_out_fold(doc_id, fold: int):
    """Whether crc32 of the id as text leaves ``fold`` when divided by 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == fold


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of held-out rows aren't read."""
    model = train(docs, labels.filter(~held_out_fold(F.col("doc_id"), 0)))
    out = docs.select("doc_id", held_out_fold(F.col("doc_id"), 0).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose text is not toxic, with their columns.

    Held-out labels are not read. Null texts stay; repeated rows are judged alike.
    """
    model = train(docs, labels.filter(~held_out_fold(F.col("doc_id"), 0)))
    return docs.filter(score_column(model, F.col("text")) < 0.5)
