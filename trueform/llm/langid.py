"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit a binary classifier over hashed byte
trigrams learns the languages with that bit from the others. A text's bits are
decoded to the language of least weighted loss. A small lead is flagged as
ambiguous, and so is a text that one of its language's bits does not support:
random letters and mixed languages can lead by far and still miss a bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trueform.llm.common import byte_slices, flat_text
from trueform.llm.textbytes import lower_ascii

BUCKET_BITS = 14
UNDETERMINED = "und"
LEAD = 0.2  # a score lead below it is ambiguous
SUPPORT = 0.4  # so is a text whose weakest bit speaks for the language by less than this mean log odds a trigram
Z95 = 1.96  # standard deviations of a 95 % interval
CLEAN_LOSS = 0.01  # share of labelled held-out documents beyond which the flag says more about the model than about a text


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams, rows end to end, and row offsets; two blanks before each text keep rows apart."""
    raw, offsets = flat_text(texts)
    rows = len(offsets) - 1
    padded = np.full(len(raw) + 2 * rows + 2, 32, dtype=np.uint8)
    padded[np.arange(len(raw)) + np.repeat(2 * np.arange(1, rows + 1), np.diff(offsets))] = lower_ascii(raw)
    padded[(padded >= 9) & (padded <= 13)] = 32
    wide = padded.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), offsets + 2 * np.arange(rows + 1)


def codewords(n: int) -> np.ndarray:
    """n distinct rows of +1 and -1: all splits of up to six languages, else random words of 10 log2 n bits."""
    if n <= 6:
        bits = np.arange(1, 1 << max(0, n - 1))
        return np.where((bits[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).reshape(n, len(bits))
    rng, best, far = np.random.default_rng(11), None, -1
    for _ in range(50):  # keep the draw whose nearest two words are farthest apart
        draw = rng.choice([-1, 1], size=(n, int(10 * np.ceil(np.log2(n)))))
        apart = (draw @ draw.T - 2 * draw.shape[1] * np.eye(n)).max()
        if best is None or apart < far:
            best, far = draw, apart
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray = field(repr=False)  # bits x buckets: log odds of the bit given the trigram
    bit_weight: np.ndarray = field(repr=False)  # how well each bit separates its languages

    def scores(self, margins: np.ndarray) -> np.ndarray:
        """Share of each language (rows sum to 1) from the mean margin of each bit."""
        loss = np.stack([(np.logaddexp(0, -8 * margins * code) * self.bit_weight).sum(1) for code in self.codes], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return share / share.sum(1, keepdims=True)


def train(rows: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModel:
    """Learns from all rows with a language and a text; the languages times 2**14 counts reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                buckets, offsets = trigrams(batch.column("text"))
                names, codes = np.unique(np.asarray(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
                of_gram = np.repeat(codes, np.diff(offsets)).astype(np.int32)
                table = np.bincount((of_gram << BUCKET_BITS) + buckets, minlength=len(names) << BUCKET_BITS).reshape(len(names), -1)
                for name, row in zip(names, table):
                    found[name] = found.get(name, 0) + row
        for name, row in found.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))], names=["lang", "bucket", "n"])

    usable = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    table = usable.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    for i, name in enumerate(languages):
        own = table[table["lang"] == name]
        counts[i, own["bucket"]] = own["n"]
    rates = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True) if languages else counts
    codes = codewords(len(languages))
    weights = np.zeros((codes.shape[1], 1 << BUCKET_BITS))
    bit_weight = np.ones(codes.shape[1])
    for b in range(codes.shape[1]):
        yes, no = rates[codes[:, b] > 0], rates[codes[:, b] < 0]
        weights[b] = np.log(yes.mean(0)) - np.log(no.mean(0))
        # least expected margin of any language on its own side
        bit_weight[b] = max(0.01, min((rates[i] * weights[b]).sum() * codes[i, b] for i in range(len(languages))))
    return LanguageModel(languages, codes, weights, bit_weight / bit_weight.mean() if len(bit_weight) else bit_weight)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``documents`` (all columns) with lang_pred, lang_score (0 to 1), lang_ambiguous.

    The whole text counts. Null text, text without a letter and a model without
    languages give ``und``, score 0, ambiguous. One language alone scores 1 and
    has no bits, so it is never ambiguous.
    Columns named like the added ones give way.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # languages and buckets bound its size
    own = [f for f in documents.schema.fields if f.name not in {"lang_pred", "lang_score", "lang_ambiguous"}]
    schema = T.StructType(own + [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_ambiguous", T.BooleanType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                texts = batch.column("text")
                buckets, offsets = trigrams(texts)
                margins = np.zeros((batch.num_rows, m.codes.shape[1]))
                sizes = np.maximum(1, np.diff(offsets))
                for b in range(m.codes.shape[1]):
                    sums = np.concatenate([[0], np.cumsum(m.weights[b][buckets])])
                    margins[:, b] = (sums[offsets[1:]] - sums[offsets[:-1]]) / sizes
                real = np.array([has_letter(t) for t in texts.to_pylist()], dtype=bool)
                if m.languages:
                    shares = m.scores(margins)
                    best = shares.argmax(1)
                    score = shares[np.arange(len(best)), best]
                    lead = score - (np.partition(shares, -2, axis=1)[:, -2] if len(m.languages) > 1 else 0)
                    support = (margins * m.codes[best]).min(axis=1, initial=np.inf)
                    names = np.array(m.languages, dtype=object)[best]
                else:
                    score = lead = support = np.zeros(batch.num_rows)
                    names, real = np.full(batch.num_rows, UNDETERMINED, dtype=object), np.zeros(batch.num_rows, dtype=bool)
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in own] + [
                    pa.array(np.where(real, names, UNDETERMINED), pa.string()), pa.array(np.where(real, score, 0.0)), pa.array(~real | (lead < LEAD) | (support < SUPPORT))], names=schema.names)

    return documents.select(*[f.name for f in own]).mapInArrow(predict, schema)


def flag_check(documents: DataFrame, model: LanguageModel, clean_loss: float = CLEAN_LOSS) -> DataFrame:
    """One row: flagged (as ambiguous) and known of the held-out documents with a label and a letter, least_loss, believed.

    ``least_loss`` is the lower end of the 95 % (Wilson) interval of the share of
    clean documents that the flag takes. The flag is believed unless that end
    lies above ``clean_loss``: then the labels themselves cannot be told apart.
    The rule is the same at every size; few documents alone disprove nothing.
    """
    known = documents.filter(held_out() & F.col("lang").isNotNull()).select("text")
    counts = identify(known, model).filter(F.col("lang_pred") != UNDETERMINED).agg(
        F.count_if("lang_ambiguous").alias("flagged"), F.count("*").alias("known"))
    n, p = F.col("known"), F.col("flagged") / F.col("known")
    low = (p + Z95 ** 2 / (2 * n) - Z95 * F.sqrt(p * (1 - p) / n + Z95 ** 2 / (4 * n * n))) / (1 + Z95 ** 2 / n)
    counts = counts.withColumn("least_loss", F.when(n > 0, F.greatest(low, F.lit(0.0))).otherwise(F.lit(0.0)))
    return counts.withColumn("believed", F.col("least_loss") <= F.lit(clean_loss))


def held_out(doc_id: str = "doc_id") -> Column:
    """A fixed quarter of the documents, never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
