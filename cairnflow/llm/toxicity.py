"""Toxicity by weak supervision.

1. *Voters.* Many small rules vote toxic, not toxic or abstain on a text: fixed
   lexicons of insults by language, words and word beginnings mined from the
   labelled rows (each with a likelihood-ratio test), and patterns (insult with
   address, repeated insults, density, spelling with digits or dots, shouting).
2. *Label model.* A generative model with one latent label per text, one vote
   distribution per voter and label, and for correlated voters the distribution
   of one vote given another, is fitted by expectation maximisation.
3. *Classifier.* A linear (logistic) model is trained on the posterior labels
   over voter and count features, and scores every text in a map.

Labels are learned from at most ``sample_rows`` labelled rows outside the
held-out part (a hash sample); scoring covers every row, without a shuffle.

Edge cases: null and empty texts have no votes and a defined score; without
labelled rows the fixed voters and the model's prior decide; labels that are
null or not 0/1 are ignored; rows with a null id are scored and not held out;
repeated rows are all returned; an empty table gives an empty result; texts are
scored whole, however long (``train`` says which are learned from); other columns
never matter, whatever they are called.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, bound_batches
from .quality import held_out, labelled_sample

WORD = re.compile(r"\w+")

# --- fixed values: common insults by language ---
LEXICON = {
    "en": "idiot idiots moron morons stupid loser losers pathetic worthless scum trash clown disgusting dumb dumbass imbecile cretin jerk bastard bitch asshole shithead retard degenerate vermin filth subhuman".split(),
    "de": "trottel dummkopf vollidiot idiot idioten abschaum wertlos erbärmlich ekelhaft widerlich versager schwachkopf arschloch miststück dreckskerl hurensohn".split(),
    "fr": "imbécile crétin débile connard connasse salaud salope ordure minable pathétique abruti bouffon dégueulasse enculé idiote".split(),
    "es": "idiota imbécil estúpido estúpida basura patético asqueroso payaso inútil cabrón pendejo gilipollas escoria".split(),
}
ADDRESS = frozenset("you your youre ur du dich ihr euch tu toi vous usted tú eres".split())
LEET = str.maketrans("013457@$", "oieastas")
STEMS = (4, 5, 6, 7)
PATTERNS = ("hits", "kinds", "dense", "address", "disguised", "shouting", "no_hit", "one_hit")
ABSTAIN, CLEAN, TOXIC = 0, 1, 2


@dataclass
class Terms:
    """Words and word beginnings that speak for toxicity, each with the number of its voter."""

    words: dict[str, int]
    stems: dict[str, int]
    several: dict[str, int]  # beginnings that only count if two different words of a text have them
    voters: list[str]
    heads: frozenset = field(default_factory=frozenset)

    @staticmethod
    def of(mined_words: list[str], mined_stems: list[str], mined_several: list[str], own_voters: int = 64) -> Terms:
        voters = [f"lexicon:{k}" for k in LEXICON]
        words = {w: i for i, k in enumerate(LEXICON) for w in LEXICON[k]}
        stems: dict[str, int] = {}
        several: dict[str, int] = {}
        for kind, found, into in (("word", mined_words, words), ("stem", mined_stems, stems), ("several", mined_several, several)):
            rest = None
            for n, t in enumerate(found):
                if t in into:
                    continue
                if n < own_voters:
                    voters.append(f"{kind}:{t}")
                    into[t] = len(voters) - 1
                else:
                    if rest is None:
                        voters.append(f"{kind}:others")
                        rest = len(voters) - 1
                    into[t] = rest
        return Terms(words, stems, several, voters + list(PATTERNS), frozenset(t[: min(STEMS)] for t in [*stems, *several]))


def terms_of(text: str) -> set[str]:
    """Distinct words of a text, their beginnings (marked -), and the beginnings of two or more of them (marked +)."""
    words = set(WORD.findall(text.lower()))
    once: set[str] = set()
    twice: set[str] = set()
    for n in STEMS:
        for w in words:
            if len(w) > n:
                t = w[:n]
                if t in once:
                    twice.add(t + "+")
                else:
                    once.add(t)
    return words | {t + "-" for t in once} | twice


def near_copies(texts: list[str | None], least: float = 0.5) -> list[bool]:
    """True for a text that is a copy of one before it that counts: copies must not count as evidence twice.

    Texts that share the least hash of their word triples, under either of two hashes, are compared; a copy has a Jaccard similarity
    of ``least`` or more of triples. A parity bitmap of each set, a bound on their difference, spares most comparisons.
    """
    seen: tuple[dict, dict] = ({}, {})  # least hash -> the texts that count
    kept: list[np.ndarray] = []
    sizes = np.zeros(len(texts))
    bits = np.zeros((len(texts), 8), np.uint64)
    out = []
    for text in texts:
        words = (text or "").lower().split()
        triples = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
        h = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(t, 1) for t in triples), np.uint64, len(triples)))
        firsts = int(h[0]), min(xxhash.xxh3_64_intdigest(t, 2) for t in triples)
        own = np.packbits(np.bincount((h >> np.uint64(55)).astype(np.int64), minlength=512).astype(np.uint8) & 1).view(np.uint64)
        met = np.array(sorted({k for s, x in zip(seen, firsts, strict=True) for k in s.get(x, ())}), np.int64)
        differ = np.bitwise_count(bits[met] ^ own).sum(axis=1, dtype=np.int64)
        met = met[(1 + least) * differ <= (1 - least) * (sizes[met] + len(h))]
        copy = any((1 + least) * len(np.intersect1d(h, kept[k], assume_unique=True)) >= least * (len(h) + len(kept[k])) for k in met)
        out.append(copy)
        if not copy:
            k = len(kept)
            sizes[k], bits[k] = len(h), own
            kept.append(h)
            for s, x in zip(seen, firsts, strict=True):
                s.setdefault(x, []).append(k)
    return out


def mine(texts: list[str | None], y: np.ndarray, chance: float = 1e-3, most: int = 2000) -> tuple[list[str], list[str], list[str]]:
    """Words, word beginnings, and beginnings shared by two words, that speak for label 1 beyond chance: share of toxic texts over 0.6, and a likelihood ratio
    that chance reaches for one of all counted terms with probability ``chance`` at most. Best first.

    Of terms that continue each other only the best stays, the longest on a tie.
    """
    if not len(y) or y.min() == y.max():
        return [], [], []
    use = [not c for c in near_copies(texts)]
    base = y[use].mean()
    pos: dict[str, int] = {}
    for text, label, ok in zip(texts, y, use, strict=True):
        if label and ok:
            for t in terms_of(text or ""):
                pos[t] = pos.get(t, 0) + 1
    pos = {t: n for t, n in pos.items() if n >= 3}
    neg: dict[str, int] = dict.fromkeys(pos, 0)
    for text, label, ok in zip(texts, y, use, strict=True):
        if not label and ok:
            for t in terms_of(text or ""):
                if t in neg:
                    neg[t] += 1
    least = 2 * math.log(max(len(pos), 1) / chance)
    rated = []
    for t, a in pos.items():
        p = a / (a + neg[t])
        if 0 < base < 1 and p > max(0.6, base):
            ratio = 2 * (a * math.log(p / base) + (neg[t] * math.log((1 - p) / (1 - base)) if neg[t] else 0))
            if ratio >= least:
                rated.append((-round(ratio, 6), -len(t.rstrip("-+")), "-+".find(t[-1]), t))
    found: tuple[list[str], list[str], list[str]] = ([], [], [])
    taken: list[str] = []
    for *_, kind, t in sorted(rated):
        plain = t.rstrip("-+")
        if len(taken) < most and not any(plain.startswith(x) or x.startswith(plain) for x in taken):
            taken.append(plain)
            found[kind + 1].append(plain)
    return found


def votes(texts: list[str | None], terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """(votes of each voter, count features) of each text."""
    v = np.zeros((len(texts), len(terms.voters)), np.int8)
    x = np.zeros((len(texts), 4))
    first = len(terms.voters) - len(PATTERNS)
    head = min(STEMS)
    for i, text in enumerate(texts):
        text = text or ""
        words = WORD.findall(text.lower())
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        hits = kinds = 0
        where = []
        shared: dict[str, list[str]] = {}
        for w, n in counts.items():
            k = terms.words.get(w)
            if k is None and w[:head] in terms.heads:
                for size in STEMS:
                    if len(w) > size:
                        k = terms.stems.get(w[:size])
                        if k is not None:
                            break
                        if w[:size] in terms.several:
                            shared.setdefault(w[:size], []).append(w)
            if k is not None:
                v[i, k] = TOXIC
                hits += n
                kinds += 1
                where.append(w)
        for t, group in shared.items():
            if len(group) > 1:
                v[i, terms.several[t]] = TOXIC
                hits += sum(counts[w] for w in group)
                kinds += len(group)
                where += group
        address = False
        if where:
            near = set(where)
            for at, w in enumerate(words):
                if w in near and not ADDRESS.isdisjoint(words[max(0, at - 3) : at + 2]):
                    address = True
                    break
        disguised = False
        if any(c in text for c in "013457@$.*-"):
            for w in text.lower().split():
                if len(w) < 40 and not w.isalpha():
                    plain = re.sub(r"[^\w]", "", w.translate(LEET))
                    if plain != re.sub(r"[^\w]", "", w) and plain in terms.words or re.fullmatch(r"(?:\w[.*\-_]){3,}\w", w) and re.sub(r"\W|_", "", w) in terms.words:
                        disguised = True
                        break
        shouting = bool(where) and any(w.upper() in text for w in where if w.upper() != w)
        n = max(1, len(words))
        for k, (toxic, clean) in enumerate([(hits >= 2, False), (kinds >= 2, False), (hits * 200 >= n and hits > 0, False), (address, False), (disguised, False), (shouting, False), (False, hits == 0), (False, hits == 1 and n > 400)]):
            v[i, first + k] = TOXIC if toxic else CLEAN if clean else ABSTAIN
        x[i] = math.log1p(hits), math.log1p(kinds), min(1.0, 50 * hits / n), 1.0 if disguised else 0.0
    return v, x


def dependence(joint: np.ndarray, bound: float) -> np.ndarray:
    """How much of the less uncertain of two votes the other tells, given the label: mutual information over entropy, 0 where the information is under ``bound``.

    joint: label x voter x state x voter x state, weights that sum to the number of texts.
    """
    p = joint / joint.sum(axis=(2, 4), keepdims=True)
    weight = joint.sum(axis=(2, 4))
    weight = weight / weight.sum(axis=0, keepdims=True)
    apart = p.sum(axis=4, keepdims=True) * p.sum(axis=2, keepdims=True)
    told = (weight * (p * np.log(np.maximum(p, 1e-12) / np.maximum(apart, 1e-12))).sum(axis=(2, 4))).sum(axis=0)
    own = np.diagonal(told)
    return np.where(told < bound, 0.0, told / np.maximum(np.minimum(own[:, None], own[None, :]), 1e-9))


def spanning_forest(strength: np.ndarray, least: float) -> list[int]:
    """Parent of each voter (-1: none) in the forest of strongest dependences, none under ``least``."""
    m = len(strength)
    parent, best, by = [-1] * m, np.full(m, -1.0), np.full(m, -1)
    out = np.ones(m, bool)
    for _ in range(m):
        k = int(np.argmax(np.where(out, best, -2.0)))
        out[k] = False
        if best[k] >= least:
            parent[k] = int(by[k])
        closer = out & (strength[k] > best)
        best[closer], by[closer] = strength[k][closer], k
    return parent


def no_worse_than_chance(table: np.ndarray, share: np.ndarray) -> np.ndarray:
    """table: label x ... x state. A vote for a label is at least as likely under it as under the other: where it is not, both get their mean by ``share``."""
    out = table.copy()
    for state, label in ((CLEAN, 0), (TOXIC, 1)):
        bad = out[label, ..., state] < out[1 - label, ..., state]
        mean = share[0] * out[0, ..., state] + share[1] * out[1, ..., state]
        for k in (0, 1):
            out[k, ..., state] = np.where(bad, mean, out[k, ..., state])
    voted = out[..., CLEAN] + out[..., TOXIC]
    out[..., ABSTAIN] = np.maximum(1 - voted, 1e-9)
    return out / out.sum(axis=-1, keepdims=True)


class LabelModel:
    """Generative model of the votes with one latent label per text.

    Its parameters are the share of toxic texts, for every voter and label a
    distribution over abstain, clean and toxic (its accuracy), and for every
    correlated pair of a forest the distribution of one vote given the other and
    the label. All are estimated together by expectation maximisation; the forest
    is drawn anew every ``redraw`` rounds from the voters' mutual information given
    the label, and holds only pairs whose dependence chance would not show.
    Voters are taken to be no worse than chance, alone and given another.
    """

    def __init__(self, v: np.ndarray, y: np.ndarray, rounds: int = 30, redraw: int = 10, chance: float = 1e-3, tie: float = 0.3):
        """y: the given labels. They set the first estimate and then count as one more voter, whose accuracy is estimated like any other's."""
        given = np.where(y > 0, TOXIC, CLEAN).astype(np.int8)[:, None]
        v = np.hstack([v, given])
        n, m = v.shape
        one_hot = np.stack([(v == s) for s in (ABSTAIN, CLEAN, TOXIC)], axis=2).astype(np.float32).reshape(n, 3 * m)
        post = np.where(y > 0, 0.95, 0.05)
        # 2 n times the information has about 8 degrees of freedom; the bound of the chi-squared tail for one of all pairs
        bound = 2 * (math.log(max(m * m, 2) / chance) + 8 * math.log(2)) / (2 * n)
        for k in range(rounds):
            shares = np.stack([1 - post, post])
            if k % redraw == 0:
                joint = np.stack([(one_hot * w[:, None].astype(np.float32)).T @ one_hot for w in shares]).reshape(2, m, 3, m, 3).astype(float)
                self.dependence = dependence(joint + 1e-3, bound)
                np.fill_diagonal(self.dependence, 0.0)
                self.parent = spanning_forest(self.dependence, tie)
            self._estimate(v, one_hot, shares)
            post = self.posterior(v)
        self.labels = post

    def _estimate(self, v: np.ndarray, one_hot: np.ndarray, shares: np.ndarray) -> None:
        m = v.shape[1]
        #: voter x label x state
        self.table = np.stack([(w @ one_hot).reshape(m, 3) + 0.1 for w in shares], axis=1)
        self.table /= self.table.sum(axis=2, keepdims=True)
        share = np.array([shares[0].mean(), shares[1].mean()])
        self.table = no_worse_than_chance(self.table.transpose(1, 0, 2), share).transpose(1, 0, 2)
        self.prior = float(np.clip(shares[1].mean(), 1e-4, 1 - 1e-4))
        #: child -> label x state of the parent x own state; a little of the voter's own distribution is mixed in
        self.pair: dict[int, np.ndarray] = {}
        for child, up in enumerate(self.parent):
            if up < 0:
                continue
            code = 3 * v[:, up].astype(np.int64) + v[:, child]
            seen = np.stack([np.bincount(code, w, 9).reshape(3, 3) for w in shares])
            seen += 2.0 * self.table[child][:, None, :]
            self.pair[child] = no_worse_than_chance(seen / seen.sum(axis=2, keepdims=True), share)

    def correlations(self) -> list[tuple[int, int, float]]:
        """(voter, voter, dependence given the label) of the pairs that the model ties."""
        return [(up, child, float(self.dependence[up, child])) for child, up in enumerate(self.parent) if up >= 0]

    def accuracy(self) -> np.ndarray:
        """Of each voter, where it does not abstain."""
        right = self.prior * self.table[:, 1, TOXIC] + (1 - self.prior) * self.table[:, 0, CLEAN]
        return right / (self.prior * (1 - self.table[:, 1, ABSTAIN]) + (1 - self.prior) * (1 - self.table[:, 0, ABSTAIN]))

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of the toxic label given all votes (the last voter: the given label)."""
        s = np.full(len(v), math.log(self.prior / (1 - self.prior)))
        alone = np.log(self.table[:, 1] / self.table[:, 0])
        for j, up in enumerate(self.parent):
            s += alone[j][v[:, j]] if up < 0 else np.log(self.pair[j][1] / self.pair[j][0])[v[:, up], v[:, j]]
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def fit_linear(x: np.ndarray, p: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    pull = np.full(len(w), ridge)
    pull[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (q - p) + pull * w
        hess = (x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    terms: Terms
    weights: np.ndarray
    labels: LabelModel | None

    def score(self, texts: list[str | None]) -> np.ndarray:
        v, x = votes(texts, self.terms)
        f = np.hstack([(v == TOXIC).astype(float) - (v == CLEAN), x])
        return 1 / (1 + np.exp(-np.clip(f @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(texts: list[str | None], y: np.ndarray) -> Model:
    """Voters, label model and classifier from labelled texts (none: the fixed voters and fixed weights)."""
    if not len(texts):
        terms = Terms.of([], [], [])
        w = np.full(len(terms.voters) + 5, 1.0)
        w[-1] = -2.0
        return Model(terms, w, None)
    terms = Terms.of(*mine(texts, y))
    v, x = votes(texts, terms)
    model = LabelModel(v, y)
    f = np.hstack([(v == TOXIC).astype(float) - (v == CLEAN), x])
    return Model(terms, fit_linear(f, model.labels), model)


def fitting(rows: DataFrame, text_budget: int) -> DataFrame:
    """The rows whose ``__text`` is no longer than an eighth of the budget; of these as large a share, by hash, as the budget holds."""
    short = rows.where(F.length("__text") <= text_budget // 8)
    size = short.agg(F.sum(F.length("__text")).alias("n")).first().n or 0
    if size <= text_budget:
        return short
    return short.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) < 1_000_000 * text_budget // size)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = 20_000, text_col: str = "text", id_col: str = "doc_id", text_budget: int = 24_000_000) -> Model:
    """Fits on the driver from a sample of at most ``sample_rows`` labelled texts, and of at most about ``text_budget`` bytes: texts of over an eighth of it are left out, and if the others together pass it, a share chosen by hash fits."""
    bound_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, label_col, sample_rows, text_col, id_col)
    some = fitting(rows, text_budget)
    texts: dict[int, tuple[str | None, float]] = {}
    for r in some.toLocalIterator():
        texts[r.doc_id] = (bytes(r["__text"]).decode("utf-8", "replace"), r.y)
    ordered = [texts[k] for k in sorted(texts)]
    return fit([t for t, _ in ordered], np.array([y for _, y in ordered]))


def _score(model: Model):
    def run(source):
        for cols in batches(source):
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["held_out"], pa.bool_()), pa.array(model.score(cols["__text"]))], names=["doc_id", "held_out", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = 20_000, threshold: float = 0.5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = train(docs, labels, label_col, sample_rows, text_col, id_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("__text"))
    out = own.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = 20_000, threshold: float = 0.5, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of docs, all columns as they are, that score below ``threshold``: one map, no shuffle."""
    model = train(docs, labels, label_col, sample_rows, text_col, id_col)

    def run(source):
        for batch in source:
            at = batch.schema.names.index(text_col)
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                yield part.filter(pa.array(model.score(part.column(at).to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)
