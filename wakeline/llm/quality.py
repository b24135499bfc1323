"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are fitted: the raw model counts, for
every n-gram bucket, the documents of the whole corpus that hold it; the target
model counts the same over the documents labelled good. A document's weight is
the sum, over its distinct n-grams, of the log ratio of the two models, and
documents are drawn without replacement with these weights by Gumbel top-k.

n-grams: words (ASCII white space apart, lower-cased, punctuation at either end
taken off), pairs of neighbouring words, word shapes (runs of capitals, small
letters, digits and each other sign collapsed to one; a word equal to the one
before has a shape of its own), and pairs of neighbouring shapes. Each kind has
its own hash space, so the models have a fixed size however large the corpus is.
A document counts once for a bucket, so neither length nor repetition adds weight.

One pass over the texts writes each row's distinct buckets, sorted, beside its
noise; both models are counted and every row is weighed from that table.

Noise: a bucket's expected target count is its raw count times the labelling
rate, taken as the median of target/raw over all buckets (weighted by raw
count). Its log ratio, with one pseudo-count, is moved ``doubt`` standard errors
towards zero, so only buckets with evidence count.

How many: k is the number of documents times the share of labelled documents
that are good, plus ``margin`` standard errors of that share (a little too many
rather than clean documents lost). The noise of a document is a keyed hash of
its id and text, so reruns agree; equal rows have equal keys, and all rows tied
with the k-th key are kept.

Defined cases: a null or empty text has weight 0. Ids are compared in their own
type and may be null (never labelled). A label row with a null counts as
unlabelled; a document labelled more than once is good if all its labels are.
No usable labels: every weight is 0 and everything is kept. ``max_labels``
bounds the sample of labelled documents (those with the smallest hashed id);
the raw model always covers every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.batches import mix64, slices
from wakeline.scratch import Scratch

#: Hash bits of words, shapes, pairs of shapes and pairs of words.
BITS = (20, 16, 16, 20)
STARTS = np.cumsum([0] + [1 << b for b in BITS])
BUCKETS = int(STARTS[-1])
MAX_LABELS = 200_000
PSEUDO = 1.0
DOUBT = 3.5
MARGIN = 1.64
SEED = 7
_BLOCK = 4096  # buckets whose counts are shuffled together
_REPEAT = np.uint64(0x5EED)
_CACHE = 200_000  # words whose hashes are remembered within a task


class _Features:
    """Distinct n-gram buckets of each text of a batch, sorted."""

    def __init__(self):
        import re

        self.known: dict[str, tuple[int, int]] = {}
        self.runs = re.compile(r"(.)\1+")

    def word(self, w: str) -> tuple[int, int]:
        from xxhash import xxh64_intdigest

        got = self.known.get(w)
        if got is None:
            core = w.strip("".join({c for c in w if not c.isalnum()})) or w
            shape = self.runs.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in w))
            got = xxh64_intdigest(core.lower(), 1), xxh64_intdigest(shape, 2)
            if len(self.known) >= _CACHE:
                self.known.clear()
            self.known[w] = got
        return got

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        ends = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        pairs = [self.word(w) for w in coded.dictionary.to_pylist()]
        table = np.array(pairs, dtype=np.uint64).reshape(-1, 2)
        code = coded.indices.to_numpy(zero_copy_only=False)
        base = int(ends[0])
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            c = code[lo - base: hi - base]
            word, shape = table[c, 0], table[c, 1]
            shape = np.where(np.r_[False, c[1:] == c[:-1]], _REPEAT, shape) if len(c) else shape
            kinds = (word, mix64(shape), mix64(shape[:-1] * np.uint64(3) + shape[1:]), mix64(word[:-1] * np.uint64(3) + word[1:]))
            yield np.unique(np.concatenate([
                (h >> np.uint64(64 - bits)).astype(np.int32) + np.int32(start)
                for h, bits, start in zip(kinds, BITS, STARTS.tolist(), strict=False)]))


def _labelled(labels: DataFrame, id_col: str, max_labels: int) -> DataFrame:
    each = labels.filter(f"{id_col} IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col(id_col).alias("id")).agg(
        F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    return each.orderBy(F.xxhash64("id"), "id").limit(max_labels)


@dataclass
class Model:
    """Log ratios of the buckets that have evidence, and the target share."""

    bucket: np.ndarray
    ratio: np.ndarray
    share: float  # of labelled documents that are good
    labelled: int


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rows: bool = False) -> DataFrame:
    """A written table with one row per document: id, noise (standard Gumbel,
    from a keyed hash of id and text), buckets (array of int, distinct, sorted)
    and, if ``rows``, the columns of ``docs`` as c0, c1, ..."""

    kept = docs.columns if rows else [id_col, text_col]
    at = kept.index(text_col)
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{id_col}`").alias("key"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    out = read.drop("key") if rows else read.select("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feats = _Features()
        for batch in batches:
            for part in slices(batch, f"c{at}"):
                texts = part.column(f"c{at}")
                found = list(feats(texts))
                ends = np.cumsum([0] + [len(b) for b in found])
                buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                columns = {c: part.column(c) for c in names}
                yield pa.RecordBatch.from_pydict({**columns, "noise": pa.array(_noise(part.column("key"), texts, seed)), "buckets": buckets})

    names = out.columns
    schema = T.StructType([*out.schema.fields, T.StructField("noise", T.DoubleType()), T.StructField("buckets", T.ArrayType(T.IntegerType()))])
    # sorted integers take half the space as differences, which Parquet's second format has
    return Scratch(docs.sparkSession, "quality").write(read.mapInArrow(run, schema), "features", **{"parquet.writer.version": "v2"})


def _planes(counts: np.ndarray) -> bytes:
    """Counts of one task as byte planes; all but the lowest are mostly zeros
    and vanish when the shuffle compresses them."""

    return np.ascontiguousarray(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _counts(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T).view("<i8").ravel()


def fit(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", max_labels: int = MAX_LABELS, doubt: float = DOUBT) -> Model:
    """Count both models over all rows of ``features`` and return the log ratios."""

    spark: SparkSession = feats.sparkSession
    sample = Scratch(spark, "quality").write(_labelled(labels, id_col, max_labels), "labels")
    n, good = sample.agg(F.count("*"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0))).first()
    if not good:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), 0.0 if n else 1.0, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy()
            each = lists.flatten().to_numpy(zero_copy_only=False)
            hit = np.repeat(batch.column("target").to_numpy(zero_copy_only=False), np.diff(ends))
            np.add.at(raw, each, 1)
            np.add.at(target, each[hit], 1)
        blocks = np.flatnonzero(raw.reshape(-1, _BLOCK).any(axis=1)).tolist()
        parts = [[_planes(x[i * _BLOCK: (i + 1) * _BLOCK]) for i in blocks] for x in (raw, target)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), *[pa.array(x, pa.binary()) for x in parts]], names=["block", "raw", "target"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # of this task's blocks: at most BUCKETS counts
        for batch in batches:
            for i, *pair in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                both = np.stack([_counts(x) for x in pair])
                sums[i] = sums[i] + both if i in sums else both
        for i, (raw, target) in sums.items():
            s = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(s + i * _BLOCK), pa.array(raw[s]), pa.array(target[s])], names=["bucket", "raw", "target"])

    chosen = F.broadcast(sample.filter("good").select(F.col("id").alias("good_id")))  # at most max_labels ids
    rows = feats.join(chosen, F.col("id") == F.col("good_id"), "left").select("buckets", F.col("good_id").isNotNull().alias("target"))
    counts = rows.mapInArrow(count, "block int, raw binary, target binary").repartition("block").mapInArrow(
        total, "bucket long, raw long, target long")
    counts = Scratch(spark, "quality").write(counts, "counts")
    rate = counts.agg(F.expr("percentile(target / raw, 0.5, raw)").alias("rate")).first().rate
    if not rate:
        rate = counts.agg(F.expr("sum(target) / sum(raw)").alias("rate")).first().rate
    if not rate:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), good / n, n)
    expected = F.col("raw") * F.lit(float(rate)) + F.lit(PSEUDO)
    log = F.log((F.col("target") + F.lit(PSEUDO)) / expected)
    sure = F.signum(log) * F.greatest(F.abs(log) - F.lit(doubt) / F.sqrt(expected), F.lit(0.0))
    kept = counts.select("bucket", sure.alias("ratio")).filter("ratio <> 0").toPandas().sort_values("bucket")  # at most BUCKETS rows
    return Model(kept["bucket"].to_numpy(dtype=np.int64), kept["ratio"].to_numpy(dtype=float), good / n, n)


def _noise(keys: pa.Array, texts: pa.Array, seed: int) -> np.ndarray:
    """Standard Gumbel noise from a keyed hash of id and text."""

    from xxhash import xxh64_intdigest

    key = keys.to_numpy(zero_copy_only=False).view(np.uint64)
    text = np.array([xxh64_intdigest(t.as_py() or "", seed) for t in texts], dtype=np.uint64)
    u = ((mix64(key * np.uint64(2) + np.uint64(seed)) ^ text) >> np.uint64(11)).astype(float)
    return -np.log(-np.log((u + 0.5) / float(1 << 53)))


def _weigher(spark: SparkSession, model: Model):
    shared = spark.sparkContext.broadcast((model.bucket, model.ratio))

    def start():
        table = np.zeros(BUCKETS)
        table[shared.value[0]] = shared.value[1]

        def of(batch: pa.RecordBatch) -> np.ndarray:
            lists = batch.column("buckets")
            each, ends = table[lists.flatten().to_numpy(zero_copy_only=False)], lists.offsets.to_numpy() - lists.offsets[0].as_py()
            # row by row, so a row's sum does not depend on its batch
            return np.array([each[a:b].sum() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], dtype=float)

        return of

    return start


def score(feats: DataFrame, model: Model) -> DataFrame:
    """(id, log_weight, noisy_key) for every row of ``features``."""

    start = _weigher(feats.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = start()
        for batch in batches:
            weight = of(batch)
            key = weight + batch.column("noise").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(weight), pa.array(key)], names=["id", "log_weight", "noisy_key"])

    schema = T.StructType([feats.schema["id"], T.StructField("log_weight", T.DoubleType()), T.StructField("noisy_key", T.DoubleType())])
    return feats.select("id", "noise", "buckets").mapInArrow(run, schema)


def kth_largest(scores: DataFrame, k: int, column: str = "noisy_key") -> float:
    """The k-th largest value of a double column (exact): the range that holds
    it is cut in 4,096 per pass, so the driver sees that many counts at most
    and nothing is sorted. Negative infinity if there are k rows or fewer."""

    whole = scores.select(F.col(column).alias("x")).filter("x IS NOT NULL")
    lo, hi, n = whole.agg(F.min("x"), F.max("x"), F.count("x")).first()
    if n <= k:
        return float("-inf")
    left = k
    while lo < hi:
        step = (hi - lo) / 4096
        cell = F.least(F.greatest(F.floor((F.col("x") - F.lit(lo)) / F.lit(step)), F.lit(0)), F.lit(4095)) if step > 0 else F.col("x")
        cells = whole.filter((F.col("x") >= lo) & (F.col("x") <= hi)).groupBy(cell.alias("c")).agg(
            F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy(F.desc("lo")).collect()
        for c in cells:
            if left <= c.n:
                lo, hi = c.lo, c.hi
                break
            left -= c.n
    return lo


def threshold(scores: DataFrame, model: Model, margin: float = MARGIN) -> float:
    """The smallest noisy key that is kept."""

    n = scores.count()
    error = (model.share * (1 - model.share) / model.labelled) ** 0.5 if model.labelled else 0.0
    k = min(n, int(np.ceil(n * (model.share + margin * error))))
    if not model.labelled or not n:
        return float("-inf") if model.share else float("inf")
    return kth_largest(scores, k) if k else float("inf")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             seed: int = SEED, **how) -> DataFrame:
    """(id_col, log_weight, noisy_key, kept) for every row of ``docs``."""

    feats = features(docs, id_col, text_col, seed)
    model = fit(feats, labels, id_col, **how)
    scores = Scratch(docs.sparkSession, "quality").write(score(feats, model), "scores")
    least = threshold(scores, model)
    return scores.select(F.col("id").alias(id_col), "log_weight", "noisy_key", (F.col("noisy_key") >= F.lit(least)).alias("kept"))


def select(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           seed: int = SEED, **how) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. The rows are written
    once beside their buckets, and weighed again there; no text is shuffled."""

    feats = features(docs, id_col, text_col, seed, rows=True)
    model = fit(feats.select("id", "buckets"), labels, id_col, **how)
    least = threshold(Scratch(docs.sparkSession, "quality").write(score(feats, model), "scores"), model)
    start = _weigher(docs.sparkSession, model)
    own = feats.columns[1:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = start()
        for batch in batches:
            stay = of(batch) + batch.column("noise").to_numpy() >= least
            yield batch.select(own).filter(pa.array(stay))

    schema = T.StructType([feats.schema[c] for c in own])
    return feats.mapInArrow(run, schema).select(*[F.col(c).alias(n) for c, n in zip(own, docs.columns, strict=True)])
