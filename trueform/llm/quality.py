"""Quality classification by hierarchical empirical Bayes.

A document's words give log-likelihood evidence; its site gives a prior. Host
and path rates come from grouped counts of labelled documents and are shrunk:
the path towards its host, the host towards the global rate, each by as much as
the groups of its level are seen to differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trueform.llm.common import byte_slices, flat_text, lean, saved, small_batches
from trueform.llm.textbytes import Hashed, U, lower_ascii, mix, runs

BUCKET_BITS = 18
FIT_ROWS = 20_000  # labelled documents the word evidence is learned from, taken by hash of doc_id
FIT_TASKS = 16  # tasks that read them; each puts out one row a bucket it saw
CHOSEN, LEAST_Z = 4000, 3.0  # buckets a target uses at most, and how many standard errors each stands out by
RIDGE, STEPS = 1e-4, 300
PREFIXES = (3, 4, 5, 6, 7, 8, 9)  # bytes; unwanted words often share a beginning

_word = np.zeros(256, dtype=bool)
_word[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_mark = ~_word
_mark[[0x20, 9, 10, 11, 12, 13]] = False


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct words of each text, of their beginnings, and of its runs of other marks.

    A bucket stands as often as distinct words of the text share it.
    """
    raw, offsets = flat_text(texts)
    raw = lower_ascii(raw)
    hashed, rows, buckets = Hashed(raw), [], []
    for mask, prefixes in ((_word, PREFIXES), (_mark, ())):
        starts, ends, first = runs(mask[raw], offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        whole = hashed.span(starts, ends)
        once = np.unique(mix(whole + mix(row.astype(np.uint64))), return_index=True)[1]
        starts, ends, row, whole = starts[once], ends[once], row[once], whole[once]
        rows.append(row)
        buckets.append(whole >> U(64 - BUCKET_BITS))
        for n in prefixes:
            longer = ends - starts > n
            rows.append(row[longer])
            buckets.append(mix(hashed.span(starts[longer], starts[longer] + n) ^ U(n)) >> U(64 - BUCKET_BITS))
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


def counted(texts: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, log(1 + count)) of the wanted buckets."""
    row, bucket = features(texts)
    keep = wanted[bucket]
    keys, n = np.unique((row[keep] << BUCKET_BITS) | bucket[keep], return_counts=True)
    return keys >> BUCKET_BITS, keys & ((1 << BUCKET_BITS) - 1), np.log1p(n)


@dataclass
class Evidence:
    weights: np.ndarray  # of each bucket's log(1 + count)
    offset: float  # of the log likelihood ratio

    def __call__(self, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        return np.bincount(row, value * self.weights[bucket], rows) + self.offset


def choose_buckets(labelled: DataFrame, targets: tuple[str, ...]) -> dict[str, np.ndarray]:
    """For each target that has both classes, the buckets whose rates differ most between them (CHOSEN at most)."""
    cells = [f"{t}_{v}" for t in targets for v in (0, 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(cells), (1 << BUCKET_BITS) + 1), np.int32)  # the last column counts texts
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                row, bucket = features(batch.column("text"))
                keys = np.unique((row << BUCKET_BITS) | bucket)
                row, bucket = keys >> BUCKET_BITS, keys & ((1 << BUCKET_BITS) - 1)
                for c, name in enumerate(cells):
                    y = np.asarray(batch.column(name[:-2]).fill_null(-1)) == int(name[-1])
                    table[c, :-1] += np.bincount(bucket[y[row]], minlength=1 << BUCKET_BITS).astype(np.int32)
                    table[c, -1] += y.sum()
        at = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(table[c, at].astype(np.int64)) for c in range(len(cells)))], names=["bucket", *cells])

    schema = "bucket long, " + ", ".join(f"`{c}` long" for c in cells)
    grouped = saved(labelled.select("text", *targets).mapInArrow(lean(count), schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in cells]), "buckets")
    totals = grouped.filter(F.col("bucket") == 1 << BUCKET_BITS).first()
    out = {}
    for t in targets:
        no, yes = (totals[f"{t}_0"], totals[f"{t}_1"]) if totals else (0, 0)
        if no and yes:
            seen = F.col(f"{t}_0") + F.col(f"{t}_1")
            pooled = (seen + 0.5) / (no + yes + 1)
            z = F.abs(F.col(f"{t}_1") / yes - F.col(f"{t}_0") / no) / F.sqrt(pooled * (1 - pooled) * (1 / no + 1 / yes))
            best = grouped.filter(F.col("bucket") < 1 << BUCKET_BITS).select("bucket", z.alias("z")).filter(F.col("z") > LEAST_Z)
            out[t] = np.array([r[0] for r in best.orderBy(F.desc("z"), "bucket").limit(CHOSEN).collect()], dtype=np.int64)
    return out


def learn(labelled: DataFrame, targets: tuple[str, ...]) -> dict[str, Evidence]:
    """Word evidence of each target from a bounded table of rows (text, targets 0 or 1).

    The buckets whose rates differ most between the classes are taken, and a
    ridge logistic regression weighs them. To the driver come the chosen buckets
    and where the bounded rows hold them.
    """
    chosen, wanted = choose_buckets(labelled, targets), np.zeros(1 << BUCKET_BITS, dtype=bool)
    for best in chosen.values():
        wanted[best] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                row, bucket, value = counted(batch.column("text"), wanted)
                bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(t).cast(pa.int32()) for t in targets), pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32))).cast(kind),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(value.astype(np.float32)))], names=[*targets, "bucket", "value"])

    schema = T.StructType([T.StructField(t, T.IntegerType()) for t in targets] + [T.StructField("bucket", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))])
    sample = labelled.select("text", *targets).mapInArrow(lean(rows), schema).toArrow()
    sizes = np.asarray(pc.list_value_length(sample.column("bucket")))
    row = np.repeat(np.arange(len(sizes)), sizes)
    bucket, value = (np.asarray(pc.list_flatten(sample.column(c)).combine_chunks()) for c in ("bucket", "value"))
    out = {}
    for name in targets:
        if name not in chosen:
            out[name] = Evidence(np.zeros(1 << BUCKET_BITS), 0.0)
            continue
        index = np.full(1 << BUCKET_BITS, -1)
        index[chosen[name]] = np.arange(len(chosen[name]))
        y = np.asarray(sample.column(name).combine_chunks().fill_null(-1)).astype(float)
        mine = (index[bucket] >= 0) & (y[row] >= 0)
        weights, bias = ridge(row[mine], index[bucket[mine]], value[mine].astype(float), y, len(chosen[name]))
        whole = np.zeros(1 << BUCKET_BITS)
        whole[chosen[name]] = weights
        rate = (y[y >= 0]).mean()
        out[name] = Evidence(whole, float(bias - np.log(rate / (1 - rate))))
    return out


def ridge(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Logistic regression of y (rows under 0 left out) by scaled gradient steps."""
    known = y >= 0
    n, weights, past = known.sum(), np.zeros(width), np.full(width, 1e-8)
    bias = float(np.log(y[known].mean() / (1 - y[known].mean())))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * weights[column], len(y)) + bias, -30, 30)))
        miss = np.where(known, p - y, 0.0)
        slope = np.bincount(column, value * miss[row], width) / n + RIDGE * weights
        past += slope * slope
        weights -= 0.5 * slope / np.sqrt(past)
        bias -= 0.5 * miss.sum() / n
    return weights, bias


def shrunk(groups: DataFrame, centre: Column, name: str) -> DataFrame:
    """Adds ``name``: the posterior rate pos/n shrunk towards ``centre``.

    The prior's strength is m = c(1-c)/v - 1, with v the variance of the groups'
    rates beyond what their sizes explain (method of moments), between 2 and 10000.
    """
    dev = F.col("pos") / F.col("n") - F.col("__c")
    base = groups.withColumn("__c", centre)
    moments = base.agg(F.sum(F.col("n") * dev * dev).alias("q"), F.sum("n").alias("t"), F.sum(F.col("__c") * (1 - F.col("__c"))).alias("w"),
                       F.count("*").alias("k"), F.sum(F.col("__c") * (1 - F.col("__c")) * F.col("n")).alias("cw")).first()
    q, t, w, k, cw = (float(x or 0) for x in moments)
    between = max(0.0, (q - w) / t) if t else 0.0
    m = min(10_000.0, max(2.0, cw / t / between - 1)) if t and between > 0 else 10_000.0
    return base.withColumn(name, (F.col("pos") + m * F.col("__c")) / (F.col("n") + m)).drop("__c")


def site_rates(labelled: DataFrame, target: str, host: str, path: str) -> tuple[DataFrame, DataFrame, float]:
    """Posterior rates of hosts and of paths within hosts, and the global rate."""
    rows = labelled.filter(F.col(target).isin(0, 1))
    paths = saved(rows.groupBy(host, path).agg(F.count("*").alias("n"), F.sum(F.col(target)).alias("pos")), "paths")
    hosts = paths.groupBy(host).agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    n, pos = (float(x or 0) for x in hosts.agg(F.sum("n"), F.sum("pos")).first())
    rate = (pos + 0.5) / (n + 1)
    hosts = saved(shrunk(hosts, F.lit(rate), "host_rate").select(host, "host_rate"), "hosts")
    joined = paths.join(hosts.withColumnRenamed(host, "__h"), F.col(host).eqNullSafe(F.col("__h"))).drop("__h")
    return hosts, saved(shrunk(joined, F.col("host_rate"), "path_rate").select(host, path, "path_rate"), "paths"), rate


def evidence_scores(documents: DataFrame, models: dict[str, Evidence]) -> DataFrame:
    """``documents`` with one log-likelihood ratio column ``<target>_evidence`` for each model."""
    shared = documents.sparkSession.sparkContext.broadcast(models)  # 2 MB a model
    added = [f"{k}_evidence" for k in models]
    own = [f for f in documents.schema.fields if f.name not in added]
    schema = T.StructType(own + [T.StructField(n, T.DoubleType()) for n in added])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        wanted = np.any([m.weights != 0 for m in models.values()], axis=0)
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                found = counted(batch.column("text"), wanted)
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in own] + [pa.array(m(*found, batch.num_rows)) for m in models.values()], names=schema.names)

    return documents.select(*[f.name for f in own]).mapInArrow(lean(score), schema)


def classify(documents: DataFrame, labels: DataFrame, targets: tuple[str, ...] = ("quality", "toxic"),
             host: str = "source", path: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per document row: doc_id, <target>_score (0 to 1) of each target, kept.

    ``kept`` is toxic_score <= 0.5. Word evidence is learned from at most
    ``fit_rows`` labelled documents, chosen by a hash of doc_id; site rates count
    every label. Labels that repeat a doc_id count once (the largest); null or
    other values are ignored. Null text has no evidence; a null host or path is
    a site like any other; a site without labels has its host's or the global
    rate. Without labels every score is 0.5 and all are kept. Null and
    repeated doc_ids are rows of the result; other columns are ignored. The
    documents have no path: ``lang`` stands in for it unless ``path`` names one.
    """
    small_batches(documents.sparkSession)
    docs = documents.select("doc_id", "text", F.col(host).alias("host"), F.col(path).alias("path"))
    one = saved(labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.max(t).alias(t) for t in targets]), "labels")
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)  # a documented bound, so it may be broadcast
    fit = saved(docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                .select("text", *[F.when(F.col(t).isin(0, 1), F.col(t).cast("int")).alias(t) for t in targets]), "fit")
    places = saved(docs.select("doc_id", "host", "path").join(one, "doc_id"), "places")
    scored = evidence_scores(docs.select("doc_id", "host", "path", "text"), learn(fit.coalesce(FIT_TASKS), targets)).drop("text")
    for t in targets:
        hosts, paths, rate = site_rates(places, t, "host", "path")
        hosts, paths = hosts.select(F.col("host").alias("h1"), "host_rate"), paths.select(F.col("host").alias("h2"), F.col("path").alias("p2"), "path_rate")
        prior = F.coalesce("path_rate", "host_rate", F.lit(rate))
        logit = F.col(f"{t}_evidence") + F.log(prior) - F.log(1 - prior)
        scored = (scored.join(hosts, F.col("host").eqNullSafe(F.col("h1")), "left")
                  .join(paths, F.col("host").eqNullSafe(F.col("h2")) & F.col("path").eqNullSafe(F.col("p2")), "left")
                  .withColumn(f"{t}_score", 1 / (1 + F.exp(-logit))).drop("h1", "h2", "p2", "host_rate", "path_rate"))
    return scored.select("doc_id", *[f"{t}_score" for t in targets], (F.col("toxic_score") <= 0.5).alias("kept") if "toxic" in targets else F.lit(True).alias("kept"))
