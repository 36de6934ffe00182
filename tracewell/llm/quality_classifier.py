"""Quality scores by positive-unlabelled learning.

Trusted documents are positives; any web text is unlabelled.  The class prior, the share of good documents in web
text, is the least ratio of the two samples' mass above a threshold of a first classifier of positives against
unlabelled text: among the most trustworthy texts there are no bad ones, and what is left of the ratio is the prior.
Then the non-negative unbiased risk with logistic loss is minimised, so scores are probabilities.

Evidence is how a text is written, not what about: shares of capitals, digits and repeated words, lengths of words and
lines, each also by its place among those of web text, and the share of every sign of ASCII.  Every text is read once:
its numbers are kept, and what is learned from all texts, means, places and masses above thresholds, comes from them.
Only the rows that weights are fitted on are a sample.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import annotate, durable, held_out, quoted, strings
from tracewell.llm.repetition import measure

_BINS = 10
_PLACES = np.linspace(0, 1, _BINS)[1:-1]


@dataclass(frozen=True)
class Settings:
    """positives and unlabelled: the most rows of each kind that are learned from."""

    positives: int = 4000
    unlabelled: int = 8000
    steps: int = 600
    rate: float = 0.05
    ridge: float = 1e-3
    folds: int = 2


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _table("0123456789")
_SIGNS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_SIGN = _table("".join(map(chr, _SIGNS)))
#: The first numbers of a text, which also count by their place among those of all texts; shares of signs follow.
_PLACED = 15


def style(texts) -> np.ndarray:
    """A row of numbers for each text."""
    texts = strings(texts)
    n_words, word_chars, _, dup_lines, repeat_words, repeat_chars, longest = (np.asarray(x, np.float64) for x in measure(texts, 5)[:7])
    raw, offs = X.byte_view(texts)
    starts, ends, first = X.words(raw, offs, "space")
    share = lambda t: X.per_row(t[raw], offs)
    size = ends - starts
    words = np.maximum(n_words, 1)
    letters = share(_UPPER) + share(_LOWER)
    lines = X.per_row(raw == 0x0A, offs) + 1
    last = raw[np.maximum(ends - 1, 0)] if len(ends) else raw[:0]
    at = np.flatnonzero(_SIGN[raw])
    signs = np.bincount((np.searchsorted(offs, at, side="right") - 1) * 128 + raw[at], minlength=128 * len(texts)).reshape(-1, 128)[:, _SIGNS]
    placed = [
        np.log1p(n_words),
        np.log1p(words / lines),
        np.log1p(lines),
        word_chars / words,
        share(_UPPER) / np.maximum(letters, 1),
        share(_DIGIT) / np.maximum(word_chars, 1),
        signs.sum(1) / words,
        X.per_row(size <= 3, first) / words,
        X.per_row(size >= 12, first) / words,
        X.per_row(_SIGN[last], first) / words,
        dup_lines / lines,
        repeat_words / words,
        repeat_chars / np.maximum(word_chars, 1),
        longest / words,
        X.per_row(raw >= 0xC0, offs) / np.maximum(word_chars, 1),
    ]
    return np.concatenate([np.stack(placed, axis=1), np.sqrt(signs / words[:, None])], axis=1)


@dataclass
class Model:
    edges: np.ndarray  # placed numbers x inner edges of bins
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float


def _expand(x: np.ndarray, edges: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    parts = [np.clip((x - mean) / scale, -4, 4)]
    for k in range(len(edges)):
        b = np.searchsorted(edges[k], x[:, k], side="right")
        parts.append((b[:, None] == np.arange(edges.shape[1] + 1)).astype(np.float64))
    return np.concatenate(parts, axis=1)


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -40, 40)))


def _adam(gradient, width: int, s: Settings) -> tuple[np.ndarray, float]:
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, s.steps + 1):
        g = gradient(w[:-1], w[-1])
        g[:-1] += s.ridge * w[:-1]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        w -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _slope(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The gradient of a sum over rows, from its derivatives by the rows' values."""
    return np.append(x.T @ d, d.sum())


def _newton(p: np.ndarray, u: np.ndarray, s: Settings, steps: int = 15) -> np.ndarray:
    """Logistic regression of p against u at equal weight, by Newton's method; the last weight is the bias."""
    x = np.concatenate([p, u])
    x = np.c_[x, np.ones(len(x))]
    y = np.arange(len(x)) < len(p)
    weight = np.where(y, 0.5 / len(p), 0.5 / len(u))
    ridge = np.append(np.full(p.shape[1], s.ridge), 1e-9)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        f = _sigmoid(x @ w)
        w -= np.linalg.solve((x * (weight * f * (1 - f))[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (f - y)) + ridge * w)
    return w


#: A fold's thresholds lie at these places among its positives; a quarter of them at least is above.
_CUTS = [0.005, 0.01, 0.02, *np.linspace(0.05, 0.75, 15)]

#: Given a classifier and its thresholds for each fold: the share of unlabelled rows of the fold above each.
Mass = Callable[[list[np.ndarray], list[np.ndarray]], list[np.ndarray]]


def class_prior(p: np.ndarray, u: np.ndarray, s: Settings, u_fold: np.ndarray | None = None, mass: Mass | None = None) -> float:
    """The share of positives in unlabelled text, from values of classifiers of p against u on rows of other folds.

    mass: what tells the unlabelled rows above thresholds; those of u itself if it isn't given.
    """
    p_fold = np.arange(len(p)) % s.folds
    u_fold = np.arange(len(u)) % s.folds if u_fold is None else u_fold
    own = lambda ws, cuts: [(np.c_[u[u_fold == k] @ w[:-1]] >= c).mean(0) for k, (w, c) in enumerate(zip(ws, cuts, strict=True))]
    ws = [_newton(p[p_fold != k], u[u_fold != k], s) for k in range(s.folds)]
    values = [p[p_fold == k] @ w[:-1] for k, w in enumerate(ws)]
    cuts = [np.quantile(f, _CUTS) for f in values]
    ratios = [np.min(x / np.maximum((f[:, None] >= c).mean(0), 1e-9)) for x, f, c in zip((mass or own)(ws, cuts), values, cuts, strict=True)]
    return float(np.clip(np.mean(ratios), 0.05, 0.99))


def _edges(v: np.ndarray) -> np.ndarray:
    """Zero has a bin of its own; the others hold equal shares of what is above."""
    above = v[v > 0]
    return np.append(1e-12, np.quantile(above, _PLACES) if len(above) else np.full(_BINS - 2, np.inf))


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray, s: Settings, stats: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None, u_fold: np.ndarray | None = None, mass: Callable | None = None) -> Model:
    """Non-negative PU risk: prior * E_p l(f) + max(0, E_u l(-f) - prior * E_p l(-f)).

    stats: edges, mean and scale; mass: what class_prior asks for, given edges, mean and scale first.  Both are taken
    from the unlabelled rows if they aren't given.
    """
    edges, mean, scale = stats or (np.stack([_edges(v) for v in unlabelled.T[:_PLACED]]), unlabelled.mean(0), unlabelled.std(0) + 1e-6)
    p, u = (_expand(x, edges, mean, scale) for x in (positive, unlabelled))
    prior = class_prior(p, u, s, u_fold, mass and partial(mass, edges, mean, scale))

    def gradient(w, b):
        fp, fu = p @ w + b, u @ w + b
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        good = _slope(p, -prior * _sigmoid(-fp) / len(p))
        bad = _slope(u, _sigmoid(fu) / len(u)) - _slope(p, prior * _sigmoid(fp) / len(p))
        return good + bad if negative >= 0 else -bad  # below zero only that part is mended

    w, b = _adam(gradient, p.shape[1], s)
    return Model(edges, mean, scale, w, b, prior)


def _matrix(column: pa.Array) -> np.ndarray:
    flat, offs = np.asarray(column.values), np.asarray(column.offsets)
    return flat[offs[0] : offs[-1]].reshape(len(column), -1)


def _numbers(docs: DataFrame, text_col: str, keep: list[str]) -> tuple[DataFrame, str]:
    """The columns `keep` and the name of one with the numbers of each text."""

    def run(texts):
        x = style(texts)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))]

    made, r = annotate(docs, [text_col], run, "x array<double>", keep)
    return made.withColumn(r, F.col(r)["x"]), r


def _statistics(x: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges, mean and scale over all rows of one column of numbers; edges within a ten-thousandth of their places."""
    name = x.columns[0]
    at = lambda k: F.get(F.col(quoted(name)), F.lit(k))
    found = x.agg(*(F.avg(at(k)).alias(f"m{k}") for k in range(width)), *(F.stddev_pop(at(k)).alias(f"s{k}") for k in range(width)), *(F.percentile_approx(F.when(at(k) > 0, at(k)), list(map(float, _PLACES)), 10_000).alias(f"e{k}") for k in range(_PLACED))).first()
    edges = np.stack([np.append(1e-12, found[f"e{k}"] or np.full(_BINS - 2, np.inf)) for k in range(_PLACED)])
    return edges, np.array([found[f"m{k}"] for k in range(width)]), np.array([found[f"s{k}"] for k in range(width)]) + 1e-6


def _above(x: DataFrame, s: Settings) -> Callable:
    """The Mass of all rows (fold, numbers): counts are made where the rows are, and summed."""

    def mass(edges, mean, scale, ws, cuts):
        def run(batches):
            n = np.zeros((s.folds, len(_CUTS) + 1), np.int64)
            for b in batches:
                fold, v = np.asarray(b.column(0)), _expand(_matrix(b.column(1)), edges, mean, scale)
                for k in range(s.folds):
                    f = v[fold == k] @ ws[k][:-1]
                    n[k] += [*(f[:, None] >= cuts[k]).sum(0), len(f)]
            yield pa.RecordBatch.from_arrays([pa.array(range(s.folds), pa.int32()), pa.array(n.tolist(), pa.list_(pa.int64()))], names=["fold", "n"])

        parts = x.mapInArrow(run, "fold int, n array<long>").select("fold", F.posexplode("n")).groupBy("fold", "pos").agg(F.sum("col").alias("n")).collect()
        total = np.zeros((s.folds, len(_CUTS) + 1))
        for r in parts:
            total[r["fold"], r["pos"]] = r["n"]
        return list(total[:, :-1] / np.maximum(total[:, -1:], 1))

    return mass


def _some(df: DataFrame, h: Column, most: int) -> DataFrame:
    """At most `most` rows, those of an interval of hashes that is expected to hold nine tenths as many."""
    n = df.count()
    return df.filter(F.pmod(h, F.lit(1_000_000)) < F.lit(int(min(1.0, 0.9 * most / max(n, 1)) * 1_000_000))).limit(most) if n > most else df


def _fit(numbers: DataFrame, labels: DataFrame, id_col: str, x_col: str, labels_id: str, label_col: str, s: Settings) -> Model | None:
    c = lambda x: F.col(quoted(x))
    trusted = labels.filter((c(label_col) == 1) & ~held_out(c(labels_id))).select(c(labels_id).alias("i")).distinct()
    trusted = durable(_some(trusted, F.xxhash64("i", F.lit(3)), s.positives))
    rows = numbers.select(c(id_col).alias("i"), c(x_col).alias("x"))
    found = [r["x"] for r in rows.filter(~held_out("i")).join(F.broadcast(trusted), "i").select("x").limit(s.positives).collect()]
    positive = np.array(sorted(found), np.float64)
    folded = rows.select("i", F.pmod(F.xxhash64("i", "x", F.lit(9)), F.lit(s.folds)).cast("int").alias("fold"), "x")
    some = _some(folded.filter(~held_out("i")), F.xxhash64("i", "x", F.lit(5)), s.unlabelled).select("fold", "x").collect()
    some = sorted((r["x"], r["fold"]) for r in some)
    if len(positive) < 2 * s.folds or any(sum(f != k for _, f in some) < 1 for k in range(s.folds)):
        return None
    stats = _statistics(rows.select("x"), positive.shape[1])
    return fit_rows(positive, np.array([x for x, _ in some]), s, stats, np.array([f for _, f in some]), _above(folded.select("fold", "x"), s))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings()) -> Model | None:
    """Learn from positive labels and any texts of rows that aren't held out; None where there are too few.

    Means, edges and masses above thresholds are those of all texts.
    """
    numbers, x = _numbers(docs, text_col, [id_col])
    return _fit(durable(numbers), labels, id_col, x, id_col, label_col, settings)


def score_numbers(x: np.ndarray, m: Model | None) -> np.ndarray:
    if m is None:
        return np.full(len(x), 0.5)
    return _sigmoid(_expand(x, m.edges, m.mean, m.scale) @ m.weights + m.bias)


def mark(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, settings: Settings = Settings(), model: Model | None = None) -> tuple[DataFrame, str]:
    """The columns `keep` of docs with a struct column of `score`, the probability of good quality, by a model learned
    from docs and labels, or one given.

    A null text is scored as the empty one.  Where nothing can be learned (a few positives at most, no texts) all
    scores are 0.5.  Ids that labels repeat count once, positive if any is.  Repeated rows are scored each; other
    columns stay; an empty table gives an empty one.  If the text isn't kept, each is read once.
    """
    keep = list(docs.columns if keep is None else keep)
    context = docs.sparkSession.sparkContext
    if text_col in keep or model is not None:
        sent = context.broadcast(model or fit(docs, labels, id_col=id_col, text_col=text_col, settings=settings))
        return annotate(docs, [text_col], lambda texts: [score_numbers(style(texts), sent.value)], "score double", keep)
    numbers, x = _numbers(docs, text_col, list(dict.fromkeys([*keep, id_col])))
    numbers = durable(numbers)
    sent = context.broadcast(_fit(numbers, labels, id_col, x, id_col, "quality", settings))
    return annotate(numbers, [x], lambda rows: [score_numbers(_matrix(rows), sent.value)], "score double", keep)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What op7 returns."""
    df, r = mark(docs, labels, keep=["doc_id"])
    x = F.col(r)["score"]
    return df.select("doc_id", held_out("doc_id").alias("held_out"), x.alias("score"), (x >= 0.7).cast("int").alias("predicted"))
