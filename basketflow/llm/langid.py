"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier per bit, over hashed byte
trigrams of the whole text, predicts the bits.  Decoding takes the codeword of
least loss, each bit's logistic loss weighted by how well its classifier does
on rows left out of the fit, and flags documents whose two best codewords are
close.

The fit reads a bounded sample: at most ``SAMPLE_ROWS`` labelled documents, the
same number per language, chosen by a hash of their id.  Everything else runs
over all documents, in one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import ship_package, text_buffer
from basketflow.llm.linear import Logistic, gram_bins, platt, row_counts, row_means, text_chunks

SAMPLE_ROWS = 3000  # bound of the labelled sample
LEAST_PER_LANGUAGE = 8
GRAM, BINS = 3, 4096
MARGIN = 0.2  # ambiguous: the best two probabilities differ by less

# A-Z fold to a-z; other ASCII bytes that are not letters fold to a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[65:91] = True


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """(languages, bits) of 0/1.  Up to 6 languages: the exhaustive code, all
    2^(n-1) - 1 ways to part them; above: the best of random dense codes by
    least distance between rows."""
    if n <= 1:
        return np.zeros((n, 0), int)
    if n <= 6:
        return np.array([[(c >> k) & 1 for c in range(1, 2 ** (n - 1))] for k in range(n)])
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best = max((rng.integers(0, 2, (n, bits)) for _ in range(64)),
               key=lambda c: min((c[a] != c[b]).sum() for a in range(n) for b in range(a)))
    return best[:, (best.min(0) == 0) & (best.max(0) == 1)]


class Decoder:
    """Bit classifiers, calibrated, with the codes and bit weights."""

    def __init__(self, x: np.ndarray, label: np.ndarray, languages: list[str]):
        self.languages = languages
        self.codes = codewords(len(languages))
        bits = self.codes[label].astype(np.float32)
        if not bits.shape[1]:
            return
        test = np.arange(len(x)) % 5 == 0
        test &= len(x) >= 20
        # Each language weighs the same in every bit.
        weight = np.repeat((1 / np.bincount(label, minlength=len(languages)))[label, None], bits.shape[1], 1)
        held = Logistic(x[~test], bits[~test], weight[~test].astype(np.float32))
        use = test if test.any() else np.ones(len(x), bool)
        margin = held.margins(x[use])
        lines = [platt(margin[:, k], bits[use, k]) for k in range(bits.shape[1])]
        self.slope = np.array([line[0] for line in lines])
        self.shift = np.array([line[1] for line in lines])
        right = ((margin * self.slope + self.shift > 0) == (bits[use] > 0)).mean(0)
        right = np.clip(right, 0.5, 1 - 1 / (use.sum() + 2))
        self.bit_weight = np.log(right / (1 - right)) + 1e-6
        self.bit_weight /= self.bit_weight.sum()
        self.model = Logistic(x, bits, weight.astype(np.float32))

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        """(rows, languages) from mean gram weights; sharper with more bits."""
        if len(self.languages) == 1:
            return np.ones((len(means), 1))
        f = (means + self.model.bias) * self.slope + self.shift
        sign = 2 * self.codes - 1
        loss = (np.logaddexp(0, -f[:, None, :] * sign[None]) * self.bit_weight).sum(-1) * len(self.bit_weight)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        return p / p.sum(1, keepdims=True)


def has_letters(data: np.ndarray, offs: np.ndarray, texts) -> np.ndarray:
    """Rows with at least one letter (any script); ``texts``: row to str."""
    def any_of(flags):
        return np.concatenate(([0], np.cumsum(flags)))[offs[1:]] - np.concatenate(([0], np.cumsum(flags)))[offs[:-1]] > 0

    out = any_of(LETTER[data])
    for r in np.flatnonzero(~out & any_of(data >= 128)).tolist():
        out[r] = any(c.isalpha() for c in texts(r))
    return out


def _features(batches):
    for batch in batches:
        data, offs = text_buffer(batch.column("text"))
        for i, j, part, at in text_chunks(data, offs):
            x = row_counts(gram_bins(part, at, FOLD, GRAM, BINS), at, BINS)
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(i, j - i),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Decoder | None:
    """Fit on labelled ``docs`` (null texts, ids and languages are left out);
    None if there are none."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")) \
        .where("id is not null and lang is not null and text is not null")
    n = rows.agg(F.count_distinct("lang")).first()[0]
    if not n:
        return None
    quota = max(LEAST_PER_LANGUAGE, sample_rows // n)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    picked = (rows.select("id", "lang").withColumn("k", F.row_number().over(order)).where(F.col("k") <= quota)
              .select("id").distinct())  # at most max(sample_rows, 8 * languages) ids
    sample = rows.join(F.broadcast(picked), "id", "left_semi").mapInArrow(_features, "lang string, x binary").collect()
    sample.sort(key=lambda r: (hash_of(r.x), r.lang))
    languages = sorted({r.lang for r in sample})
    x = np.frombuffer(b"".join(r.x for r in sample), np.float32).reshape(len(sample), BINS)
    return Decoder(x, np.array([languages.index(r.lang) for r in sample]), languages)


def hash_of(x: bytes) -> int:
    import zlib
    return zlib.crc32(x)


def predict(docs: DataFrame, decoder: Decoder | None, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred`` (``und`` without letters or without a
    model), ``score`` (0 to 1; 0 for ``und``), ``lang_next``, and
    ``ambiguous``.  Columns of these names are replaced."""
    new = {"lang_pred": T.StringType(), "score": T.DoubleType(), "lang_next": T.StringType(),
           "ambiguous": T.BooleanType()}
    docs = docs.drop(*new)
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(decoder)

    def run(batches):
        found = model.value
        for batch in batches:
            column = batch.column(text_col)
            data, offs = text_buffer(column)
            for i, j, part, at in text_chunks(data, offs):
                known = has_letters(part, at, lambda r: column[i + r].as_py())
                known &= found is not None
                names, score, second, close = (np.full(j - i, "und", object), np.zeros(j - i),
                                               np.full(j - i, None, object), known.copy())
                if known.any():
                    if len(found.languages) > 1:
                        means = row_means(found.model.weights, gram_bins(part, at, FOLD, GRAM, BINS), at)
                    else:
                        means = np.zeros((j - i, 0))
                    p = found.probabilities(means)
                    order = np.argsort(-p, 1, kind="stable")
                    best = np.take_along_axis(p, order[:, :2], 1)
                    words = np.array(found.languages, object)
                    names[known], score[known] = words[order[known, 0]], best[known, 0]
                    if p.shape[1] > 1:
                        second[known] = words[order[known, 1]]
                        close = known & (best[:, 0] - best[:, 1] < margin)
                    else:
                        close[:] = False
                rows = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(names.tolist(), pa.string()), pa.array(score),
                     pa.array(second.tolist(), pa.string()), pa.array(close)],
                    names=[*batch.schema.names, *new])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(c, t) for c, t in new.items())]))


def report(docs: DataFrame) -> DataFrame:
    """The ``op2`` contract: a fifth of the documents, by crc32 of the id, is
    held out of the fit."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    decoder = fit(rows.where(~F.col("held_out")))
    return predict(rows.select("doc_id", "text", "held_out"), decoder).select(
        "doc_id", "held_out", "lang_pred", "score", "lang_next", "ambiguous")
