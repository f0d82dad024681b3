"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learned first: whole words and word beginnings whose share among documents labelled toxic is
well above their share among the others. Features of a text are densities of lexicon hits, their nearness
to second-person words, capitals, punctuation and obfuscated spellings; they cover the whole text. Trees
are grown on all labelled rows and calibrated on all of them, by folds: a row's features come from a lexicon
of the other folds, and its margin for calibration from trees of the other folds, so that none of the three
judges rows it has seen.

Bounds: at most `max_labelled` labelled rows (20,000, those of smallest hash) train the model, and the
lexicon has at most `max_terms` entries (4,000); both are parameters and neither grows with the corpus.

Defined cases. Null text counts as empty; empty text has the score of a text without hits. Without training
labels of both kinds every score is the share of label 1 (0 without labels). Null labels are left out, and
null ids are never held out. Rows repeat as given. Input columns with the name of a result column are
replaced.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Bounded
from .shared import documents, map_arrow, stored, worker_keeps

MAX_LABELLED = 20_000
MAX_TERMS = 4_000
THRESHOLD = 0.7
FOLDS = 3
#: Second-person words of the corpus's four languages.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine deiner deinen deinem ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split())
#: Characters that stand for letters in obfuscated spellings.
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "-": None, ".": None, "_": None})
WORD = re.compile(r"[^\W\d_]+")
NEAR = 6
PREFIXES = (3, 4, 5, 6, 7)


def terms_of(word: str) -> list[str]:
    """A lower-case word and its beginnings."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k)]


@dataclass
class Features:
    """Turns texts into feature rows. A piece (what stands between white space) is looked at once and then kept in a bounded table."""

    lexicon: dict[str, float]
    most: int = 200_000
    columns: int = 12
    table: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.starts = {t[:3] for t in self.lexicon}
        self.clear()

    def clear(self) -> None:
        self.table, self.rows, self.at = {}, np.zeros((self.most, self.columns), np.float32), 0

    def weight(self, word: str) -> float:
        if word[:3] not in self.starts:
            return 0.0
        get = self.lexicon.get
        return max([get(t, 0.0) for t in terms_of(word)], default=0.0)

    def piece(self, piece: str) -> list[float]:
        body = piece[:-1] if piece[-1] in ".,;:" else piece
        capital = body[:1].isupper()
        if body.isalpha() and (body[1:] if capital else body).islower():  # most pieces: a plain word, with a mark or without
            low = body.lower()
            if low.isalpha():
                weight = self.weight(low)
                return [1, weight > 0, weight, weight >= 3, low in SECOND, len(low), capital, 0, 0, len(piece) - len(body), 0, 0.0]
        low = piece.lower()
        words = WORD.findall(low)
        weights = [self.weight(w) for w in words]
        best = max(weights, default=0.0)
        other = 0.0
        if best <= 0 and not low.isalpha():
            other = max([self.weight(w) for w in WORD.findall(low.translate(STANDS_FOR))], default=0.0)
        letters = sum(map(len, words))
        upper = sum(c.isupper() for c in piece)
        marks = piece.count("!") + piece.count("?")
        odd = sum(not c.isalnum() for c in piece)
        mixed = bool(letters) and bool(re.search(r"[^\W\d_][\d@$*!][^\W\d_]", piece))
        return [
            len(words), sum(w > 0 for w in weights), sum(weights), best >= 3, any(w in SECOND for w in words), letters,
            upper, letters > 2 and upper == letters, marks, odd, mixed, other,
        ]

    def index(self, piece: str) -> int:
        at = self.table.get(piece)
        if at is None:
            at = self.at
            self.rows[at] = self.piece(piece)
            self.table[piece] = at
            self.at += 1
        return at

    def of(self, text: str | None) -> np.ndarray:
        pieces = (text or "").split()
        total, near, best, hits_in_row, before = np.zeros(self.columns), 0, 0.0, 0, np.zeros((0, 2), bool)
        for start in range(0, len(pieces), 20_000):
            block = pieces[start : start + 20_000]
            if self.at + len(block) > self.most:
                self.clear()
            found = list(map(self.table.get, block))
            if None in found:
                found = [self.index(p) if k is None else k for p, k in zip(block, found)]
            got = self.rows[found]
            total += got.sum(axis=0, dtype=np.float64)
            best = max(best, float(got[:, 2].max(initial=0)))
            flags = np.concatenate([before, np.stack([(got[:, 1] > 0) | (got[:, 11] > 0), got[:, 4] > 0], axis=1)])
            hit, you = np.flatnonzero(flags[:, 0]), np.flatnonzero(flags[:, 1])
            if len(hit) and len(you):
                after = np.searchsorted(you, hit)
                gap = np.minimum(np.abs(you[np.minimum(after, len(you) - 1)] - hit), np.abs(you[np.maximum(after - 1, 0)] - hit))
                near += int(((gap <= NEAR) & (hit >= len(before))).sum())
            hits_in_row += int((np.diff(hit) <= 2).sum())
            before = flags[-NEAR:]
        words, letters = max(total[0], 1.0), max(total[5], 1.0)
        size = max(len(text or ""), 1)
        return np.array([
            total[1], total[1] / words, total[2] / words, best, total[3] / words, total[3], near / words, near, total[4] / words, total[6] / letters,
            total[7] / words, total[8] / size, total[9] / size, total[10] / words, float(total[11] > 0), total[11] / words, hits_in_row, np.log1p(total[0]),
        ])


NAMES = (
    "hits", "hit_density", "weight_density", "best_weight", "strong_density", "strong", "near_second_density", "near_second", "second_density", "capitals",
    "shouted_words", "exclamation_rate", "punctuation_rate", "obfuscation_rate", "any_hidden_hit", "hidden_density", "hits_in_row", "log_words",
)


class Trees:
    """Boosted trees of fixed depth for a logistic loss, on features cut at quantiles."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, penalty: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.penalty = rounds, depth, rate, bins, penalty

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        for k, c in enumerate(x.T):  # a rare value above the rest must be reachable by a cut
            self.cuts[k] = np.unique(np.concatenate([self.cuts[k], np.quantile(c[c > c.min()], [0.0, 0.25, 0.5, 0.75]) if (c > c.min()).any() else []]))
        code = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(self.cuts, x.T)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            leaf, nodes = np.zeros(len(y), int), [self._grow(code, p - y, np.maximum(p * (1 - p), 1e-6))]
            tree = nodes[0]
            leaf = self._leaf(tree, code)
            score += tree[2][leaf]
            self.trees.append(tree)
        return self

    def _grow(self, code, grad, hess):
        n = 2**self.depth
        which, at = np.zeros(n - 1, int), np.full(n - 1, 1 << 30)
        place = np.zeros(len(grad), int)  # in the level
        for level in range(self.depth):
            first = 2**level - 1
            for node in range(2**level):
                own = np.flatnonzero(place == node)
                if len(own) < 20:
                    continue
                g, h = grad[own], hess[own]
                gain, top = 1e-6, g.sum() ** 2 / (h.sum() + self.penalty)
                for k, cut in enumerate(self.cuts):
                    if not len(cut):
                        continue
                    left_g = np.cumsum(np.bincount(code[own, k], g, len(cut) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(code[own, k], h, len(cut) + 1))[:-1]
                    found = left_g**2 / (left_h + self.penalty) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + self.penalty) - top
                    best = int(found.argmax())
                    if found[best] > gain:
                        gain, which[first + node], at[first + node] = found[best], k, best
            place = 2 * place + (code[np.arange(len(grad)), which[first + place]] > at[first + place])
        g, h = np.bincount(place, grad, n), np.bincount(place, hess, n)
        return which, at, -self.rate * g / (h + self.penalty)

    def _leaf(self, tree, code):
        which, at, _ = tree
        place, rows = np.zeros(len(code), int), np.arange(len(code))
        for level in range(self.depth):
            node = 2**level - 1 + place
            place = 2 * place + (code[rows, which[node]] > at[node])
        return place

    def margin(self, x: np.ndarray) -> np.ndarray:
        code = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(self.cuts, x.T)], axis=1)
        return self.base + sum(t[2][self._leaf(t, code)] for t in self.trees)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best non-decreasing fit of y over x, by pooling neighbours that violate the order; equal x are pooled first."""
    at, where = np.unique(x, return_inverse=True)
    weight = np.bincount(where).astype(float)
    mean = np.bincount(where, y) / weight
    blocks: list[list[float]] = []
    for a, m, w in zip(at, mean, weight):
        blocks.append([m, w, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, hi = blocks.pop()
            m1, w1, lo, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, lo, hi])
    xs = np.array([p for b in blocks for p in (b[2], b[3])])
    return xs, np.array([b[0] for b in blocks for _ in range(2)])


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    points: tuple[np.ndarray, np.ndarray] | None
    share: float
    mark: str = field(default_factory=lambda: uuid.uuid4().hex)

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(features), self.share)
        return np.clip(np.interp(self.trees.margin(features), *self.points), 0.0, 1.0)


def _fold(doc_id) -> F.Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(11)), F.lit(FOLDS)).cast("int")


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_labelled: int) -> DataFrame:
    """(text, toxic, fold) of at most max_labelled rows that may train: crc32 of the id as text, modulo 3, is not 1."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stored(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", _fold(F.col("doc_id")).alias("fold")), "toxicity-labelled")


def _term_counts(rows: DataFrame, among: frozenset[str] | None = None) -> DataFrame:
    """term, fold, n: documents that hold a term, by fold; of all terms, or of those `among`. rows: text, fold."""
    shared = rows.sparkSession.sparkContext.broadcast(among)

    def count(batches):
        import pyarrow as pa

        wanted = shared.value
        n, seen = [Counter() for _ in range(FOLDS)], Bounded(terms_of if wanted is None else lambda w: [t for t in terms_of(w) if t in wanted])

        def flush():
            for fold, own in enumerate(n):
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([fold] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())], names=["term", "fold", "n"])
                own.clear()

        for batch in batches:
            for text, fold in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n[fold].update({t for w in set(WORD.findall((text or "").lower())) for t in seen[w]})
                if sum(map(len, n)) > 400_000:
                    yield from flush()
        yield from flush()

    return map_arrow(rows.select("text", F.col("fold").cast("int").alias("fold")), count, "term string, fold int, n long").groupBy("term", "fold").agg(F.sum("n").alias("n"))


def count_terms(rows: DataFrame, least: int = 4) -> DataFrame:
    """term, fold, pos, neg: documents of either label that hold a term, by fold, of terms that `least` toxic documents hold. rows: text, toxic, fold.

    Toxic documents are counted first; the others are searched for what these have in common, a part of the words of max_labelled documents.
    """
    pos = stored(_term_counts(rows.where("toxic = 1")), "toxicity-terms")
    common = pos.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("term").toArrow().column(0).to_pylist()
    neg = _term_counts(rows.where("toxic = 0"), frozenset(common))
    both = pos.select("term", "fold", F.col("n").alias("pos"), F.lit(0).alias("neg")).unionByName(neg.select("term", "fold", F.lit(0).alias("pos"), F.col("n").alias("neg")))
    return stored(both.groupBy("term", "fold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxicity-counts")


def learn_lexicon(counts: DataFrame, totals: dict[tuple[int, int], int], without: int | None = None, max_terms: int = MAX_TERMS, least: int = 4) -> dict[str, float]:
    """Terms of toxic documents with their weight, the logarithm of how much likelier they are there. `without` is a fold that is left out; totals: documents by fold and label."""
    pos, neg = (sum(n for (fold, y), n in totals.items() if y == label and fold != without) for label in (1, 0))
    if not pos or not neg:
        return {}
    own = counts if without is None else counts.where(F.col("fold") != without)
    sums = own.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    weight = F.log((F.col("pos") + 0.5) / (pos + 1.0)) - F.log((F.col("neg") + 0.5) / (neg + 1.0))
    kept = sums.where(F.col("pos") >= least).withColumn("weight", weight).where("weight > 1.5 and pos > 0.5 * neg")
    return {r.term: float(r.weight) for r in kept.orderBy(F.desc(F.col("weight") * F.sqrt("pos")), "term").limit(max_terms).collect()}


def _features(rows: DataFrame, lexica: list[dict[str, float]]) -> DataFrame:
    """x, toxic, fold: features of each row by the lexicon that its fold has no part in."""

    def run(batches):
        import pyarrow as pa

        make = [Features(lexicon, 60_000) for lexicon in lexica]
        for batch in batches:
            x = [make[fold].of(t.as_py()).tolist() for t, fold in zip(batch.column(0), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "fold"])

    by_fold = rows.repartition("fold", F.pmod(F.xxhash64("text"), F.lit(4)))  # a task has few folds, and so few tables to fill
    return map_arrow(by_fold.select("text", F.col("toxic").cast("int").alias("toxic"), F.col("fold").cast("int").alias("fold")), run, "x array<double>, toxic int, fold int")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS) -> Model:
    """The model of all labelled rows. Lexica and trees that judge a fold's rows, for features and for calibration, are those of the other folds."""
    rows = labelled(docs, labels, id_col, text_col, max_labelled)
    totals = {(r.fold, r.toxic): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    n, toxic = sum(totals.values()), sum(k for (_, y), k in totals.items() if y == 1)
    share = toxic / n if n else 0.0
    if not toxic or toxic == n:
        return Model({}, None, None, share)
    counts = count_terms(rows)
    lexicon = learn_lexicon(counts, totals, None, max_terms)
    table = _features(rows, [learn_lexicon(counts, totals, k, max_terms) for k in range(FOLDS)]).collect()  # one short row for each of max_labelled rows at most
    x, y, fold = np.array([r.x for r in table]), np.array([r.toxic for r in table], float), np.array([r.fold for r in table])
    margin = np.zeros(len(y))
    for k in range(FOLDS):
        own, others = fold == k, fold != k
        if own.any():
            margin[own] = Trees().fit(x[others], y[others]).margin(x[own]) if len(set(y[others])) == 2 else 0.0
    return Model(lexicon, Trees().fit(x, y), isotonic(margin, y), share)


def score_documents(df: DataFrame, model: Model, text_col: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """`df`, or its columns `keep`, with double `out`, from 0 to 1. The model is of bounded size and is broadcast."""
    import pyarrow as pa

    kept = [f for f in df.schema.fields if f.name != out and (keep is None or f.name in keep)]
    names = [f.name for f in kept]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        make = worker_keeps(("features", model.mark), lambda: Features(model.lexicon))
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                x = np.array([make.of(t.as_py()) for t in batch.column(text_col)])
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(model.scores(x), pa.float64())], names=[*names, out])

    return map_arrow(df, run, T.StructType([*kept, T.StructField(out, T.DoubleType())]))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = score_documents(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_toxicity": op2_toxicity}
SQL: dict[str, str] = {}
