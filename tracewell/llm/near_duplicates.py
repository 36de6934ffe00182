"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. One pass over the texts: the set of word shingles of each document, a 128-bit key of the set, `minima` minima of
   which the low `bits` bits are kept in a packed signature, and a key for each band of `rows` minima.
2. Equal sets become one class, so copies never meet each other.
3. Classes that share a band's bucket are candidates.  In a bucket of up to `small` classes each pair whose packed
   signatures, corrected for chance collisions of the low bits, leave the asked similarity within six standard errors
   goes on to be confirmed.
4. Larger buckets are linked in two steps.  First each of their classes is paired with one other, in `chosen` of its
   buckets: with a hub of the bucket, a class whose signature is nearest to what most have in each place, or else with
   the nearest class before it, in order of set sizes, that looks alike.  What those pairs link is most of a group of
   copies.  Then only buckets that still hold several components are looked at again, each by itself: classes that
   aren't of its largest component are compared with all, in blocks of bounded size.  Signatures alone tell which classes have a partner in another component at all,
   and sets are only brought together for those, in tasks that emit a spanning forest of the links they find.
5. Links, all confirmed by exact intersection of the full sets, give connected components.

With 24 bands of 4, a pair at similarity 0.85 is missed with probability 2e-8.  Buckets that merely touch are never
compared; hot buckets are split by blocks; hot classes are aggregated before they are shuffled; nothing about documents
reaches the driver but the sizes of tables.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import textops as X
from tracewell.llm.common import annotate, durable, fresh, prepare, quoted, rekeyed, release, strings
from tracewell.llm.graph import components
from tracewell.operators import sketch
from tracewell.session import compact, drop_kept, kept_so_far, tasks_of

_NIBBLE = np.uint64(0x1111111111111111)
_LANES = np.arange(16, dtype=np.uint64) * np.uint64(4)
_SEED = np.uint64(0xD1B54A32D192ED03)
#: Up to this many candidate documents are found again in the texts behind a Bloom filter, of some 8 MB then.
_FILTERED = 1 << 23
#: The most names of rows that are sent to every executor.
_SENT = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Link sets with 100 * intersection >= percent * union."""

    shingle: int = 3
    percent: int = 85
    minima: int = 128
    bands: int = 24
    rows: int = 4
    small: int = 16
    block_sets: int = 1024
    block_shingles: int = 500_000
    chosen: int = 8
    hubs: int = 4
    reach: int = 32
    chunk: int = 1 << 15
    bits: int = 4  # four fill a nibble, which is what match_counts counts

    def alike(self, n, m) -> np.ndarray:
        """Whether sets of these sizes can be linked at all."""
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    @property
    def error(self) -> float:
        """The standard error of an estimate at the similarity asked for."""
        c = 2.0**-self.bits
        p = c + (1 - c) * self.percent / 100
        return (p * (1 - p) / self.minima) ** 0.5 / (1 - c)

    @property
    def least_estimate(self) -> float:
        return self.percent / 100 - 6 * self.error


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, end to end, and where each row's begin."""
    raw, offs = X.byte_view(strings(texts))
    raw = X.lowered(raw)
    starts, ends, first = X.words(raw, offs, "space")
    h = X.span_hashes(raw, starts, ends)
    sh, at = X.windows(h, first, k)
    n = np.diff(first)
    row = np.searchsorted(first, at, side="right") - 1 if len(at) else at
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):  # the whole sequence is one shingle
        whole = np.array([X.windows(h[first[r] : first[r + 1]], np.array([0, n[r]]), int(n[r]))[0][0] for r in few], np.uint64)
        sh = np.concatenate([sh, X.mix(whole + n[few].astype(np.uint64))])
        row = np.concatenate([row, few])
        by = np.argsort(row, kind="stable")
        sh, row = sh[by], row[by]
    begin = np.searchsorted(row, np.arange(len(n) + 1))
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        sh[a:b].sort()
    if len(sh):
        new = np.empty(len(sh), bool)
        new[0] = True
        np.not_equal(sh[1:], sh[:-1], out=new[1:])
        new[begin[:-1][np.diff(begin) > 0]] = True
        begin = np.concatenate([[0], np.cumsum(new)])[begin]
        sh = sh[new]
    return sh, begin


def minhash(sh: np.ndarray, begin: np.ndarray, minima: int) -> np.ndarray:
    """rows x minima; rows with empty sets must be left out."""
    a = X.mix(np.arange(1, minima + 1, dtype=np.uint64) * _SEED) | np.uint64(1)
    b = X.mix(a)
    out = np.empty((len(begin) - 1, minima), np.uint64)
    step = 1 << 15
    lo = 0
    while lo < len(begin) - 1:  # a few rows at a time stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(begin, begin[lo] + step, side="right")) - 1)
        x, at = sh[begin[lo] : begin[hi]], begin[lo:hi] - begin[lo]
        for k in range(minima):
            out[lo:hi, k] = np.minimum.reduceat(x * a[k] + b[k], at)
        lo = hi
    return out


def pack(low: np.ndarray) -> np.ndarray:
    """The low four bits of each minimum, sixteen to a word."""
    v = (X.mix(low) & np.uint64(15)).reshape(len(low), -1, 16)
    return np.bitwise_or.reduce(v << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2)


def match_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many lanes packed signatures agree, by counting bits of their difference."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return a.shape[-1] * 16 - np.bitwise_count(x & _NIBBLE).sum(-1, dtype=np.int64)


def estimate(matches: np.ndarray, s: Settings) -> np.ndarray:
    """Similarity, corrected for lanes that agree by chance."""
    c = 2.0**-s.bits
    return (matches / s.minima - c) / (1 - c)


def _signatures(s: Settings, texts) -> list:
    sh, begin = shingle_sets(texts, s.shingle)
    n = np.diff(begin)
    full = np.flatnonzero(n)
    k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    bands = np.zeros((len(full), s.bands), np.uint64)
    packed = [None] * len(n)
    if len(full):
        at = np.append(begin[full], len(sh))
        k1[full] = np.add.reduceat(sh, at[:-1])
        k2[full] = np.add.reduceat(X.mix(sh + _SEED), at[:-1])
        low = minhash(sh, at, s.minima)
        for b in range(s.bands):
            key = np.full(len(full), b, np.uint64)
            for r in range(s.rows):
                key = X.mix(key + low[:, b * s.rows + r])
            bands[:, b] = key
        words = pack(low)
        for i, r in enumerate(full.tolist()):
            packed[r] = words[i].tobytes()
    first = np.concatenate([[0], np.cumsum(np.where(n > 0, s.bands, 0))])
    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bands.reshape(-1).view(np.int64)))
    return [n, k1.view(np.int64), k2.view(np.int64), lists, pa.array(packed, pa.binary())]


def _small_pairs(batch: pa.RecordBatch, s: Settings) -> pa.RecordBatch:
    """Pairs of a bucket's classes that their signatures don't rule out."""
    members = batch.column("members")
    first = np.asarray(members.offsets).astype(np.int64)
    flat = members.values
    ids, n = np.asarray(flat.field("rep")), np.asarray(flat.field("n"))
    raw, offs = X.byte_view(flat.field("sig"))
    sig = raw[offs[0] : offs[-1]].view(np.uint64).reshape(len(ids), -1)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sizes = np.diff(first)
    for m in np.unique(sizes):
        i, j = np.triu_indices(m, 1)
        at = first[:-1][sizes == m]
        left.append((at[:, None] + i).reshape(-1))
        right.append((at[:, None] + j).reshape(-1))
    i, j = np.concatenate(left), np.concatenate(right)
    ok = s.alike(n[i], n[j])
    i, j = i[ok], j[ok]
    ok = estimate(match_counts(sig[i], sig[j]), s) >= s.least_estimate
    i, j = i[ok], j[ok]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))], names=["a", "b"])


def _signature_rows(column: pa.Array) -> np.ndarray:
    raw, offs = X.byte_view(column)
    return raw[offs[0] : offs[-1]].view(np.uint64).reshape(len(column), -1)


def _most_common(sig: np.ndarray) -> np.ndarray:
    """What most rows have in each lane."""
    n = 16 * sig.shape[1]
    counts = np.zeros(16 * n, np.int64)
    for lo in range(0, len(sig), 1024):
        lanes = ((sig[lo : lo + 1024, :, None] >> _LANES) & np.uint64(15)).reshape(-1, n).astype(np.int64)
        counts += np.bincount((lanes + 16 * np.arange(n)).reshape(-1), minlength=16 * n)
    return counts.reshape(n, 16).argmax(1).astype(np.uint64)


def hub_of(n: np.ndarray, sig: np.ndarray, s: Settings) -> np.ndarray:
    """For each row the hub that it is most like, -1 for none; there are `hubs` at most, one after another.

    Estimates may be three standard errors too low, as what is paired is confirmed; a hub is sought for the rows that
    are surely not near one yet.
    """
    out, best = np.full(len(n), -1), np.full(len(n), s.percent / 100 - s.error * 3)
    left = np.arange(len(n))
    for _ in range(s.hubs):
        if len(left) < 2:
            break
        usual = np.bitwise_or.reduce(_most_common(sig[left]).reshape(-1, 16) << _LANES, axis=1)
        hub = left[match_counts(sig[left], usual).argmax()]
        like = np.where(s.alike(n, n[hub]), estimate(match_counts(sig, sig[hub]), s), 0)
        like[hub] = 0
        at = np.flatnonzero(like >= best)
        out[at], best[at] = hub, like[at]
        left = left[(left != hub) & (best[left] < s.percent / 100)]
    return out


def nearest_alike(run: np.ndarray, n: np.ndarray, sig: np.ndarray, s: Settings) -> np.ndarray:
    """For each row the nearest of the `reach` rows before it, of the same run, that seems to be linked; -1 for none."""
    out = np.full(len(run), -1)
    for d in range(1, min(s.reach, len(run) - 1) + 1):
        at = np.flatnonzero((out[d:] < 0) & (run[d:] == run[:-d]) & s.alike(n[d:], n[:-d])) + d
        at = at[estimate(match_counts(sig[at], sig[at - d]), s) >= s.percent / 100]
        out[at] = at - d
    return out


def _partners(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """A pair for each row (bucket, salt, n, rep, sig) that has a partner; rows of a run, in that order, come together."""
    held: list[pa.RecordBatch] = []

    def pairs(rows: pa.RecordBatch, cuts: np.ndarray) -> pa.RecordBatch:
        n, rep, sig = np.asarray(rows.column(2)), np.asarray(rows.column(3)), _signature_rows(rows.column(4))
        to = np.full(len(n), -1)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            hub = hub_of(n[a:b], sig[a:b], s)
            to[a:b] = np.where(hub < 0, -1, hub + a)
        run = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        rest = np.flatnonzero(to < 0)
        near = nearest_alike(run[rest], n[rest], sig[rest], s)
        to[rest] = np.where(near < 0, -1, rest[near])
        at = np.flatnonzero(to >= 0)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[at], rep[to[at]])), pa.array(np.maximum(rep[at], rep[to[at]]))], names=["a", "b"])

    for b in itertools.chain(batches, [None]):
        if b is not None and b.num_rows:
            held.append(b)
        if not held:
            continue
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bucket, salt = np.asarray(rows.column(0)), np.asarray(rows.column(1))
        cuts = np.concatenate([[0], np.flatnonzero((bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])) + 1])
        if b is None:
            cuts = np.append(cuts, rows.num_rows)
        if len(cuts) > 1:
            yield pairs(rows.slice(0, int(cuts[-1])), cuts)
        held = [rows.slice(int(cuts[-1]))] if cuts[-1] < rows.num_rows else []


def live_rows(bucket: int, side: np.ndarray, label: np.ndarray, n: np.ndarray, sig: np.ndarray, bands: np.ndarray, s: Settings) -> np.ndarray:
    """Which rows of a pair of blocks have one on the other side, of another component, that may be linked.

    A pair is looked at in the first bucket that it shares.
    """
    out = np.zeros(len(n), bool)
    here, there = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for i in here.tolist():
        j = there[(label[there] != label[i]) & s.alike(n[there], n[i])]
        j = j[estimate(match_counts(sig[j], sig[i]), s) >= s.least_estimate]
        if len(j):
            j = j[bands[i][(bands[j] == bands[i]).argmax(1)] == bucket]
            out[j] = True
            out[i] |= len(j) > 0
    return out


def block_links(ids: np.ndarray, part: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], s: Settings, component: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the two parts of a pair of blocks (or within one block).

    A set whose shingles mostly occur in no other set here can't be linked; lengths and signatures rule out more.
    The rest are compared exactly, those with the most common shingles first, but for pairs joined already, or of the
    same component.
    """
    n = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    shared = np.bincount(owner, weights=counts[inverse] > 1, minlength=len(sets)).astype(np.int64)
    live = np.flatnonzero(100 * shared >= s.percent * n)
    live = live[np.argsort(-(shared[live] / n[live]), kind="stable")]
    where = np.concatenate([[0], np.cumsum(n)])
    two = part.min() != part.max()
    # rows of one component begin joined; label[i] stands for all rows joined with i
    label = np.arange(len(sets)) if component is None else np.unique(component, return_inverse=True)[1]
    mark = np.zeros(len(counts), bool)
    out = []
    for k, i in enumerate(live[:-1].tolist()):
        j = live[k + 1 :]
        j = j[label[j] != label[i]]
        if two:
            j = j[part[j] != part[i]]
        j = j[s.alike(n[j], n[i])]
        if len(j):
            j = j[estimate(match_counts(sig[j], sig[i]), s) >= s.least_estimate]
        if not len(j):
            continue
        mine = inverse[where[i] : where[i + 1]]
        mark[mine] = True
        m = n[j]
        idx = np.arange(m.sum()) + np.repeat(where[j] - (np.cumsum(m) - m), m)
        both = np.add.reduceat(mark[inverse[idx]].astype(np.int64), np.cumsum(m) - m)
        mark[mine] = False
        for x in j[100 * both >= s.percent * (n[i] + m - both)].tolist():
            if label[x] != label[i]:
                label[label == label[x]] = label[i]
                out.append((int(ids[i]), int(ids[x])))
    return out


def _sets(docs: DataFrame, wanted: DataFrame, signatures: DataFrame, id_col: str, text_col: str, s: Settings, tasks: int) -> DataFrame:
    """(rep, set, n, sig) of the wanted ids, from their texts; most other texts are left out before anything is shuffled.

    An id that several texts share has several sets: links are told by id, so any of them counts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("rep"), F.col(quoted(text_col)).alias("text"))
    n = wanted.count()
    if not n:
        texts = texts.filter(F.lit(False))
    elif n <= _FILTERED:
        bloom = sketch.build(wanted.select(F.col("rep").cast("string").alias("line")), n=max(n, 1000), fpp=0.02)
        texts = texts.filter(sketch.may_contain(spark, bloom, F.col("rep").cast("string")))
    texts = texts.join(wanted, "rep", "left_semi").coalesce(tasks)

    def to_set(column):
        sh, begin = shingle_sets(column, s.shingle)
        return [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(sh.view(np.int64)))]

    sets, r = annotate(texts, ["text"], to_set, "set array<long>", ["rep"])
    return compact(sets.select("rep", f"{r}.set").filter(F.size("set") > 0).join(signatures, "rep").coalesce(tasks))


def _still_apart(hot: DataFrame, labels: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """(bucket, i, j, side, rep, label): classes of hot buckets that may be linked with one of another component.

    hot: (bucket, rep, size).  No sets are looked at.  Most classes of a bucket are of one component by now, so it is
    the others that are compared with all: in a bucket of m classes, k of other components, the others are cut into
    k / block_sets blocks and all into m / block_sets, and each class is copied for each block that it meets, with some
    300 bytes.  Rows of a bucket never meet but in blocks; what they must know of it is told to all tasks, or beyond
    _SENT buckets by a join that Spark can split.
    """
    tasks = 2 * tasks_of(reps)
    here = hot.join(labels, "rep", "left").select("bucket", "rep", "size", F.coalesce("component", "rep").alias("label"))
    counted = here.groupBy("bucket", "label").agg(F.count("*").alias("c")).coalesce(tasks)
    apart = counted.groupBy("bucket").agg(F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("all")).filter(F.col("all") > F.col("most.c"))
    apart = compact(apart.select("bucket", F.col("most.label").alias("major"), F.ceil((F.col("all") - F.col("most.c")) / s.block_sets).cast("long").alias("others"), F.ceil(F.col("all") / s.block_sets).cast("long").alias("blocks")).coalesce(tasks))
    apart = F.broadcast(apart) if apart.count() <= _SENT else rekeyed(apart, "bucket")
    rows = here.drop("size").join(apart, "bucket").join(reps.select("rep", "n", "sig", "bands"), "rep").coalesce(tasks)
    where = lambda k: F.pmod(F.xxhash64("rep", F.lit(7)), F.col(k))
    each = lambda k: F.sequence(F.lit(0).cast("long"), F.col(k) - 1)
    minor = F.transform(F.when(F.col("label") != F.col("major"), each("blocks")).otherwise(F.array().cast("array<long>")), lambda j: F.struct(F.lit(0).alias("side"), where("others").alias("i"), j.alias("j")))
    all_ = F.transform(each("others"), lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), where("blocks").alias("j")))
    blocks = rows.select("bucket", "rep", "label", "n", "sig", "bands", F.explode(F.concat(minor, all_)).alias("at")).select("bucket", "at.i", "at.j", "at.side", "rep", "label", "n", "sig", "bands")

    def live(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        col = lambda name: t.column(name).to_numpy()
        bands = t.column("bands").combine_chunks()
        bands = np.asarray(bands.values)[bands.offsets[0].as_py() :].reshape(t.num_rows, -1)
        on = live_rows(t.column("bucket")[0].as_py(), col("side"), col("label"), col("n"), _signature_rows(t.column("sig").combine_chunks()), bands, s)
        return t.select(["bucket", "i", "j", "side", "rep", "label"]).filter(pa.array(on))

    return blocks.groupBy("bucket", "i", "j").applyInArrow(live, "bucket long, i long, j long, side int, rep long, label long")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    A document's set holds its distinct shingles of `shingle` words, A-Z in lower case; with fewer words the whole
    sequence is one.  Documents without words, or of null text, have empty sets and stand alone.  component_id is the
    least id that links lead to.  Ids are whole numbers and name documents: rows that repeat an id with the same
    text get the same answer, and rows that repeat it with other texts are classed by their own texts, where classes of
    the same least id count as one. A row without an id is linked with nothing: its component is null and it is kept.  An empty table gives an empty one; other columns are not looked at.
    """
    s = settings
    prepare(docs.sparkSession)
    signed, r = annotate(docs, [text_col], lambda texts: _signatures(s, texts), "n long, k1 long, k2 long, bands array<long>, sig binary", [id_col])
    signed = compact(signed.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), f"{r}.*"))
    # what follows is of about that size, however many partitions a session gives a shuffle; twice, so that joins with sets have room
    tasks = 2 * tasks_of(signed)
    full = signed.filter("n > 0 and doc_id is not null")
    # bands and signatures follow from the set, so any row of a class will do
    reps = compact(full.groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "sig"), "doc_id").alias("x")).select("k1", "k2", "n", "rep", "x.bands", "x.sig").coalesce(tasks))
    first = kept_so_far(docs.sparkSession)

    member = reps.select("rep", F.explode("bands").alias("bucket"))  # a class has each bucket once
    counted = member.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("least")).filter("size > 1").coalesce(tasks)
    met = compact(member.join(rekeyed(counted, "bucket"), "bucket").coalesce(tasks))
    signatures = reps.select("rep", "n", "sig").dropDuplicates(["rep", "sig"]).coalesce(tasks)
    pairs = (
        met.filter(F.col("size") <= s.small).select("bucket", "rep").join(signatures, "rep").coalesce(tasks)
        .groupBy("bucket").agg(F.collect_list(F.struct("rep", "n", "sig")).alias("members"))
        .select("members").coalesce(tasks).mapInArrow(lambda it: (_small_pairs(b, s) for b in it if b.num_rows), "a long, b long").filter("a <> b").distinct().coalesce(tasks)
    )
    # larger buckets: one partner a class, in some of its buckets, the same ones for classes that share them
    hot = met.filter(F.col("size") > s.small).select("bucket", "rep", "size")
    by_hash = F.sort_array(F.collect_list(F.struct(F.xxhash64("bucket").alias("h"), "bucket", "size")))
    some = hot.groupBy("rep").agg(F.slice(by_hash, 1, s.chosen).alias("x")).select("rep", F.explode("x").alias("x")).select("rep", "x.bucket", "x.size")
    salted = some.withColumn("salt", F.pmod(F.xxhash64("rep", "bucket"), F.ceil(F.col("size") / s.chunk).cast("long"))).join(signatures, "rep").coalesce(tasks)
    dealt = salted.select("bucket", "salt", "n", "rep", "sig").repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "n", "rep").coalesce(tasks)
    chained = dealt.mapInArrow(lambda it: _partners(it, s), "a long, b long").filter("a <> b")
    pairs = compact(pairs.unionByName(chained).distinct().coalesce(tasks))
    release(docs.sparkSession)

    wanted = compact(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct().coalesce(tasks))
    sets = _sets(docs, wanted, signatures, id_col, text_col, s, tasks)
    a, b = sets.select(F.col("rep").alias("a"), F.col("set").alias("x")), sets.select(F.col("rep").alias("b"), F.col("set").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    links = pairs.join(a, "a").coalesce(tasks).join(b, "b").filter(100 * common >= s.percent * (F.size("x") + F.size("y") - common)).select(F.col("a").alias("u"), F.col("b").alias("v"))
    links = compact(links.coalesce(tasks))
    release(docs.sparkSession)

    # what those links leave apart in the larger buckets
    if hot.limit(1).count():
        live = compact(_still_apart(hot, components(links).withColumnRenamed("node", "rep"), reps, s).coalesce(tasks))
        release(docs.sparkSession)
        more = live.select("rep").distinct().join(wanted, "rep", "left_anti")
        if live.limit(1).count():
            sets = sets.unionByName(_sets(docs, compact(more.coalesce(tasks)), signatures, id_col, text_col, s, tasks))

            def forest(t: pa.Table) -> pa.Table:
                lists = t.column("set").combine_chunks()
                flat, offs = np.asarray(lists.values).view(np.uint64), np.asarray(lists.offsets)
                found = block_links(t.column("rep").to_numpy(), t.column("side").to_numpy(), _signature_rows(t.column("sig").combine_chunks()), [flat[x:y] for x, y in zip(offs[:-1], offs[1:], strict=True)], s, t.column("label").to_numpy())
                return pa.table({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([y for _, y in found], pa.int64())})

            links = links.unionByName(live.join(sets, "rep").coalesce(tasks).groupBy("bucket", "i", "j").applyInArrow(forest, "u long, v long"))
    found = components(compact(links.coalesce(tasks)))
    drop_kept(docs.sparkSession, first, kept_so_far(docs.sparkSession) - 1)  # all that led to found
    named = reps.select("k1", "k2", "n", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", "n", F.coalesce("component", "rep").alias("component")).coalesce(tasks)
    out = signed.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Settings, ...] = (Settings(),)) -> DataFrame:
    """The documents with one of each component left, the one of least id, with all their columns.

    Texts that any of the rules links are of one component. Of rows that repeat an id with the same text, one stays.
    Rows that repeat an id with other texts are judged each by its own text. Rows without an id all stay.
    """
    here = fresh("row")
    named = F.col(quoted(id_col)).isNotNull()
    # names a row by its id and text, so an id's other texts are other nodes
    rows = docs.filter(named).withColumn(here, F.xxhash64(F.col(quoted(id_col)).cast("long"), F.coalesce(F.col(quoted(text_col)), F.lit(""))))
    edges = None
    for s in rules:
        first = kept_so_far(docs.sparkSession)
        found = compact(classes(rows, id_col=here, text_col=text_col, settings=s).filter("not kept").select(F.col("doc_id").alias("u"), F.col("component_id").alias("v")).distinct())
        edges = found if edges is None else edges.unionByName(found)
        drop_kept(docs.sparkSession, first, kept_so_far(docs.sparkSession) - 1)  # all that led to found
        release(docs.sparkSession)
    linked = components(edges)
    counted = rows.groupBy(F.col(here).alias("node")).agg(F.min(F.col(quoted(id_col)).cast("long")).alias("id"), F.count("*").alias("n"))
    seen = compact(counted.join(linked, "node", "left").filter("n > 1 or component is not null"))
    first = seen.filter("component is not null").groupBy("component").agg(F.min(F.struct("id", "node")).alias("x")).select(F.col("x.node").alias("node"))
    gone = compact(seen.filter("component is not null").select("node").join(first, "node", "left_anti"))
    repeated = seen.filter("n > 1").select("node").join(gone, "node", "left_anti")

    def small(df: DataFrame) -> DataFrame:  # texts are only shuffled past what is too large to be sent around
        df = compact(df.withColumnRenamed("node", fresh("node")))
        return F.broadcast(df) if df.count() <= _SENT else df

    gone, repeated = small(gone), small(repeated)
    left = rows.join(gone, F.col(here) == F.col(gone.columns[0]), "left_anti")
    same = F.col(here) == F.col(repeated.columns[0])
    once, more = left.join(repeated, same, "left_anti"), left.join(repeated, same, "left_semi").dropDuplicates([here])
    return once.unionAll(more).drop(here).unionAll(docs.filter(~named))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, least(len(ws), 3) AS k, unnest(range(1, len(ws) - least(len(ws), 3) + 2)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 85 * (na.n + nb.n - p.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""
