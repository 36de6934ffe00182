"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to `longest` characters, in lower case and with white space as one sign, are hashed to `buckets`.
Document frequencies count every document that may be learned from.  Weights are fitted by follow-the-regularised-
leader with L1 and L2 penalties, which leaves most at zero, on a bounded sample of each language; a temperature fitted
on a part of the sample that the weights haven't seen makes scores probabilities.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import annotate, held_out, prepare, quoted, strings

UNDETERMINED = "und"
@cache
def _kinds() -> np.ndarray:
    """Of each code point: 1 for white space, 2 for a letter, 0 for any other."""
    return np.array([1 if chr(c).isspace() else 2 if chr(c).isalpha() else 0 for c in range(0x110000)], np.uint8)


@dataclass(frozen=True)
class Settings:
    """sample: the most documents that weights are fitted on, shared evenly among the languages."""

    longest: int = 3
    bucket_bits: int = 15
    sample: int = 2000
    passes: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float


@dataclass
class Grams:
    """The buckets that n-grams of some texts fall in, ascending in each text, and how often; cuts between the texts."""

    at: np.ndarray
    n: np.ndarray
    first: np.ndarray
    lettered: np.ndarray  # whether a text has a letter


def grams(texts: pa.Array, s: Settings) -> Grams:
    low = pc.utf8_lower(strings(texts))
    raw, offs = X.byte_view(low)
    cp = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offs]
    kind = _kinds()[cp]
    lettered = X.per_row(kind == 2, first) > 0
    white = kind == 1
    keep = ~white
    keep[1:] |= ~white[:-1]
    keep[:1] = True
    keep[first[:-1][first[:-1] < len(cp)]] = True  # a text begins anew
    cp = np.where(white, np.uint32(0x20), cp)[keep]
    first = np.concatenate([[0], np.cumsum(keep)])[first]
    hashed, h = [], np.zeros(len(cp), np.uint32)
    for n in range(1, s.longest + 1):
        h = (h[: max(0, len(cp) - n + 1)] + cp[n - 1 :]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        hashed.append(((h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - s.bucket_bits)).astype(np.int32))
    at, n, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [0]
    for lo, hi in itertools.pairwise(first.tolist()):
        total = np.bincount(np.concatenate([x[lo : max(lo, hi - k)] for k, x in enumerate(hashed)]), minlength=1 << s.bucket_bits)
        found = np.flatnonzero(total != 0)
        at.append(found)
        n.append(total[found])
        sizes.append(len(found))
    return Grams(np.concatenate(at), np.concatenate(n), np.cumsum(sizes), lettered)


def counts(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text's n-grams fall in, ascending, and how often."""
    g = grams(pa.array([text], pa.string()), s)
    return g.at, g.n


def vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length, with the logarithm of counts."""
    x = (1 + np.log(n)) * idf[at]
    size = np.sqrt((x * x).sum())
    return x / size if size else x


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], idf: np.ndarray, k: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal, a document at a time, in an order that depends on the seed alone.  Returns weights and biases."""
    d = len(idf)
    z, n = np.zeros((d + 1, k)), np.zeros((d + 1, k))  # the last row is the bias, which has no penalty
    data = [(np.append(at, d), np.append(vector(at, c, idf), 1.0), y) for at, c, y in rows]

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at < d, s.l1, 0.0)[:, None]
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2))

    r = np.random.default_rng(7)
    for _ in range(s.passes):
        for i in r.permutation(len(data)):
            at, x, y = data[i]
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(d + 1))
    return w[:d], w[d]


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least loss, by golden-section search on its logarithm.

    Labels count as certain only up to 1 / (n + 2), so a faultless small sample doesn't make every score 1.
    """
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        p = np.log(np.maximum(_softmax(logits / np.exp(t)), 1e-12))
        true, off = p[np.arange(len(y)), y], 1 / (len(y) + 2)
        return -float(((1 - off) * true + off * (p.sum(1) - true) / max(p.shape[1] - 1, 1)).mean())

    lo, hi, g = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> Model:
    """Learn from the texts and languages of rows that aren't held out; frequencies from all of them."""
    s, spark = settings, docs.sparkSession
    prepare(spark)
    c = lambda x: F.col(quoted(x))
    rows = docs.filter(c(lang_col).isNotNull() & ~held_out(c(id_col))).select(c(id_col).alias("i"), c(text_col).alias("t"), c(lang_col).cast("string").alias("l"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << s.bucket_bits, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            total += np.bincount(grams(batch.column(0), s).at, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(total[at], n), pa.int64())], names=["bucket", "n"])

    seen = rows.select("t").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = dict(zip(seen["bucket"].tolist(), seen["n"].tolist(), strict=True))
    total = df.pop(-1, 0)
    freq = np.zeros(1 << s.bucket_bits)
    freq[list(df)] = list(df.values())
    idf = np.log((1 + total) / (1 + freq)) + 1

    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}  # one a language
    languages = sorted(sizes)
    if not languages:
        return Model([], idf, np.zeros((len(idf), 0)), np.zeros(0), 1.0)
    each = max(1, s.sample // len(languages))
    # an interval of hashes that is expected to hold a tenth and a few more rows than are wanted, of each language
    wide = 1 << 40
    share = spark.createDataFrame([(k, int(min(1.0, (1.1 * each + 30) / n) * wide)) for k, n in sizes.items()], "l string, below long")
    h = F.pmod(F.xxhash64("i", F.lit(11)), F.lit(wide))
    sample = rows.join(F.broadcast(share), "l").withColumn("h", h).filter("h < below").select("t", "l", "h")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = grams(batch.column(0), s)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *(pa.ListArray.from_arrays(pa.array(g.first, pa.int32()), pa.array(x, pa.int32())) for x in (g.at, g.n))], names=["l", "h", "at", "n"])

    got = sample.mapInArrow(features, "l string, h long, at array<int>, n array<int>").limit(2 * s.sample + 60 * len(languages)).collect()
    got.sort(key=lambda r: (r["h"], r["l"], len(r["at"])))
    place = Counter()
    got = [r for r in got if (place.update([r["l"]]) or place[r["l"]] <= each)]
    made = [(np.array(r["at"], np.int64), np.array(r["n"], np.float64), languages.index(r["l"])) for r in got if r["at"]]
    fitted, spare = [x for i, x in enumerate(made) if i % 5], made[::5]
    weights, bias = fit_weights(fitted, idf, len(languages), s)
    logits = np.array([vector(at, n, idf) @ weights[at] + bias for at, n, _ in spare]).reshape(len(spare), len(languages))
    return Model(languages, idf, weights, bias, calibrate(logits, np.array([y for _, _, y in spare], np.int64)))


def predict(texts: pa.Array, m: Model, s: Settings) -> tuple[list[str], np.ndarray]:
    """Languages and scores."""
    if not m.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    g = grams(texts, s)
    row = X.row_of(g.first)
    x = (1 + np.log(g.n)) * m.idf[g.at]
    size = np.sqrt(np.bincount(row, weights=x * x, minlength=len(texts)))
    x /= np.maximum(size, 1e-300)[row]
    logits = np.stack([np.bincount(row, weights=x * w[g.at], minlength=len(texts)) for w in np.ascontiguousarray(m.weights.T)], axis=1) + m.bias
    p = _softmax(logits / m.temperature)
    best = np.where(g.lettered, p.argmax(1), len(m.languages))
    names = [*m.languages, UNDETERMINED]
    return [names[k] for k in best.tolist()], np.where(g.lettered, p.max(1), 0.0)


def mark(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep: list[str] | None = None, settings: Settings = Settings(), model: Model | None = None) -> tuple[DataFrame, str]:
    """The columns `keep` of docs with a struct column of lang_pred and score, by a model learned from docs, or one given.

    A null text, one without a letter, and any text where nothing could be learned is `und` at score 0.  Ties go to the
    language first by name.  Repeated rows are predicted each; other columns stay as they are; an empty table gives an
    empty one.  A language none of whose rows falls into the sample has no weights but its bias.
    """
    s = settings
    if model is None:
        model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, settings=s)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        names, scores = predict(texts, sent.value, s)
        return [pa.array(names, pa.string()), scores]

    return annotate(docs, [text_col], run, "lang_pred string, score double", list(docs.columns if keep is None else keep))


def identified(docs: DataFrame, *, least: float = 0.3, **options) -> DataFrame:
    """The documents whose language is told with at least this score, with all their columns."""
    df, r = mark(docs, **options)
    return df.filter((F.col(r)["lang_pred"] != UNDETERMINED) & (F.col(r)["score"] >= least)).drop(r)


def digest(docs: DataFrame) -> DataFrame:
    """What op6 returns."""
    df, r = mark(docs, keep=["doc_id"])
    return df.select("doc_id", held_out("doc_id").alias("held_out"), F.col(r)["lang_pred"].alias("lang_pred"), F.col(r)["score"].alias("score"))
