"""Quality classifier by co-training two views of a document.

* The text view: hashed byte bigrams of the whole text and its shape (kinds of
  characters, word lengths, repeated words and lines).
* The metadata view: hashed values of the given columns, alone and in pairs,
  and the magnitude of numbers.

Starting from the labelled rows, each round fits both views and lets them judge
all other documents, in tasks.  Every document of which a view is sure, by its
calibrated confidence, is a pseudo-label for the other view: the tasks sum its
features for the other view, by class and by one of ``GROUPS`` groups (a hash of
the text), and the other view's next fit takes the means of these groups as
examples, weighted by their number.  So all documents take part at every size,
and what reaches the driver is a few hundred vectors.  In the end both views are
calibrated on labelled rows that no fit has seen, and combined by a logistic
model of their log-odds, which also decides how much each view counts.

The labelled rows are a bounded sample, ``LABELLED_ROWS`` documents chosen by a
hash of their id (one row of each id: the one whose text has the least hash);
labelled documents beyond it are judged like unlabelled ones.  Every document is
scored, in one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import byte_table, ship_package, text_buffer, words
from basketflow.llm.linear import Logistic, gram_bins, platt, row_counts, row_means, sigmoid, text_chunks

LABELLED_ROWS = 3000  # bound of the sample
ROUNDS = 3
CONFIDENT = 0.95
GROUPS = 16  # means of pseudo-labelled documents by class
FAN_IN = 64  # tasks whose sums are added up by one
KEEP = 0.5  # documents with a lower score are rejected
GRAM, BINS, META_BINS = 2, 2048, 1024

_RAW = np.arange(256, dtype=np.uint8)
_SPACES = byte_table({0x20, *range(0x09, 0x0E)}, lower=True)
_KINDS = np.zeros((256, 8))  # one column by kind of byte
_KINDS[97:123, 0] = _KINDS[65:91, 1] = _KINDS[48:58, 2] = _KINDS[32, 3] = _KINDS[10, 4] = _KINDS[128:, 5] = 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum()], 6] = 1
_KINDS[[b for b in range(32) if b not in (9, 10, 13)], 7] = 1
STEPS = 8  # distinct and top word shares also as steps, so a linear model can bend
SHAPE = 8 + 7 + 2 * STEPS
WIDTHS = [BINS + SHAPE, META_BINS]  # features of the views


def shape(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, SHAPE) numbers between 0 and about 1; zero for empty rows."""
    out = np.zeros((len(offs) - 1, SHAPE))
    size = offs[1:] - offs[:-1]
    s, e, h, by_row = words(data, offs, _SPACES)
    length = np.concatenate(([0], np.cumsum(e - s)))
    for r in np.flatnonzero(size).tolist():
        row = data[offs[r]:offs[r + 1]]
        out[r, :8] = np.bincount(row, minlength=256) @ _KINDS / size[r]
        a, b = by_row[r], by_row[r + 1]
        if b > a:
            held = np.sort(h[a:b])
            last = np.concatenate((np.flatnonzero(held[1:] != held[:-1]), [b - a - 1]))  # of each word
            out[r, 8] = (length[b] - length[a]) / (b - a) / 20
            out[r, 9] = len(last) / (b - a)
            out[r, 10] = np.diff(last, prepend=-1).max() / (b - a)
            out[r, 11] = np.log1p(b - a) / 10
            out[r, 14] = (h[a + 1:b] == h[a:b - 1]).sum() / (b - a)  # words that repeat the one before
            out[r, 15 + min(STEPS - 1, int(out[r, 9] * STEPS))] = 1
            out[r, 15 + STEPS + min(STEPS - 1, int(out[r, 10] * STEPS))] = 1
        lines = [x for x in row.tobytes().replace(b"\r", b"\n").split(b"\n") if x]
        if lines:
            out[r, 12] = 1 - len(set(lines)) / len(lines)
            out[r, 13] = np.log1p(len(lines)) / 10
    return out


def _bucket(value: str) -> int:
    return zlib.crc32(value.encode("utf-8")) % META_BINS


def meta_features(rows: list[tuple], names: list[str]) -> np.ndarray:
    """(rows, META_BINS): a row's values, pairs of values and magnitudes."""
    kinds, of_row = meta_kinds(rows, names)
    return kinds[of_row]


def meta_kinds(rows: list[tuple], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different features of the rows, and which of them every row has."""
    memory: dict[tuple, int] = {}  # by values
    kinds: dict[tuple, int] = {}  # by what counts of the values
    for row in rows:
        if row not in memory:
            parts = tuple(f"{n}={int(np.log2(abs(v) + 1)) if isinstance(v, (int, float)) and v == v and abs(v) < 1e300 else v}"
                          for n, v in zip(names, row))
            memory[row] = kinds.setdefault(parts, len(kinds))
    out = np.zeros((len(kinds), META_BINS), np.float32)
    for parts, k in kinds.items():
        pairs = [f"{a}&{b}" for i, a in enumerate(parts) for b in parts[i + 1:]]
        out[k, [_bucket(p) for p in [*parts, *pairs]]] = 1
    return out, np.fromiter((memory[row] for row in rows), np.int64, len(rows))


@dataclass
class Views:
    text: Logistic
    meta: Logistic
    text_line: tuple  # slope, intercept of the calibration
    meta_line: tuple
    both: tuple  # weights of the two log-odds and an intercept
    names: list

    def scores(self, text_margin: np.ndarray, meta_margin: np.ndarray) -> tuple[np.ndarray, ...]:
        t = np.clip(text_margin * self.text_line[0] + self.text_line[1], -12, 12)
        m = np.clip(meta_margin * self.meta_line[0] + self.meta_line[1], -12, 12)
        return sigmoid(t), sigmoid(m), sigmoid(self.both[0] * t + self.both[1] * m + self.both[2])


def confident(views: list[tuple[Logistic, tuple]], margins: list[np.ndarray]) -> list[np.ndarray]:
    """By receiving view: the class (1, 0, or -1: not sure) that the other
    view gives every row."""
    given = []
    for (_, line), margin in zip(views, margins):
        p = sigmoid(margin * line[0] + line[1])
        given.append(np.where(p >= CONFIDENT, 1, np.where(1 - p >= CONFIDENT, 0, -1)))
    return given[::-1]


def cotrain(text: np.ndarray, meta: np.ndarray, label: np.ndarray, names: list[str], rounds: int = ROUNDS,
            exchange=None) -> Views | None:
    """``label``: 1 good, 0 bad, -1 unlabelled.  ``exchange`` tells, for the
    two fitted views, what each receives: means of pseudo-labelled rows, their
    classes and how many rows each stands for; without it the rows labelled -1
    are judged.  None without both classes."""
    known = np.flatnonzero(label >= 0)
    if len(set(label[known].tolist())) < 2:
        return None
    # A third of each class is left for the calibration.
    held = np.zeros(len(label), bool)
    for c in (0, 1):
        own = known[label[known] == c]
        held[own[::3]] = len(own) >= 3
    train = known[~held[known]]
    judge = known[held[known]] if held.any() else known
    views = (text, meta)

    def among_rows(fitted):
        pool = np.flatnonzero(label < 0)
        classes = confident(fitted, [m.margins(x[pool])[:, 0] for (m, _), x in zip(fitted, views)])
        sums = Sums([x.shape[1] for x in views])
        sums.add([dense(x[pool]) for x in views], classes, np.arange(len(pool)) % GROUPS)
        return sums.means()

    given = [None, None]  # what each view has received

    def fit(v: int) -> tuple[Logistic, tuple]:
        x, y = views[v][train], label[train].astype(np.float32)
        # Both classes weigh the same; pseudo-labels weigh half of the labels.
        w = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))
        if given[v] is not None and len(given[v][1]):
            means, classes, n = given[v]
            of_class = np.where(classes > 0, n[classes > 0].sum(), n[classes == 0].sum())
            x, y = np.concatenate((x, means.astype(np.float32))), np.concatenate((y, classes))
            w = np.concatenate((w, 0.25 * n / of_class))
        model = Logistic(x, y.astype(np.float32)[:, None], w.astype(np.float32)[:, None])
        return model, platt(model.margins(views[v][judge])[:, 0], label[judge])

    for _ in range(rounds):
        given = (exchange or among_rows)([fit(0), fit(1)])
    (t, t_line), (m, m_line) = fit(0), fit(1)
    odds = np.stack([np.clip(model.margins(x[judge])[:, 0] * line[0] + line[1], -12, 12)
                     for model, x, line in ((t, text, t_line), (m, meta, m_line))], 1)
    return Views(t, m, t_line, m_line, platt(odds, label[judge]), names)


class Sums:
    """Sums of features by receiving view, class and group."""

    def __init__(self, widths: list[int]):
        self.n = np.zeros((2, 2, GROUPS))
        self.x = [np.zeros((2, GROUPS, w)) for w in widths]

    def add(self, features: list, classes: list[np.ndarray], groups: np.ndarray) -> None:
        """``features``: by view, a function that adds the features of rows to
        a sum."""
        for v in (0, 1):
            place = np.where(classes[v] >= 0, classes[v] * GROUPS + groups, -1)
            for k in np.unique(place[place >= 0]).tolist():
                rows = np.flatnonzero(place == k)
                self.n[v, k // GROUPS, k % GROUPS] += len(rows)
                features[v](rows, self.x[v][k // GROUPS, k % GROUPS])

    def rows(self) -> list[tuple[int, float, bytes]]:
        """(key, rows, sum) of the groups that hold any."""
        return [((v * 2 + c) * GROUPS + g, self.n[v, c, g], self.x[v][c, g].tobytes())
                for v in (0, 1) for c in (0, 1) for g in range(GROUPS) if self.n[v, c, g]]

    def put(self, key: int, n: float, x: bytes) -> None:
        v, c, g = key // (2 * GROUPS), key // GROUPS % 2, key % GROUPS
        self.n[v, c, g] += n
        self.x[v][c, g] += np.frombuffer(x)

    def means(self) -> list[tuple]:
        out = []
        for v in (0, 1):
            c, g = np.nonzero(self.n[v])
            n = self.n[v][c, g]
            out.append((self.x[v][c, g] / n[:, None], c, n))
        return out


def _text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.concatenate((row_counts(gram_bins(data, offs, _RAW, GRAM, BINS), offs, BINS),
                           shape(data, offs).astype(np.float32)), 1)


def dense(x: np.ndarray):
    """Adds rows of a matrix up."""
    def add(rows: np.ndarray, to: np.ndarray) -> None:
        to += x[rows].sum(0, dtype=np.float64)
    return add


def of_kinds(kinds: np.ndarray, of_row: np.ndarray):
    """Adds rows up that have one of a few features each."""
    def add(rows: np.ndarray, to: np.ndarray) -> None:
        held, n = np.unique(of_row[rows], return_counts=True)
        to += n.astype(np.float64) @ kinds[held].astype(np.float64)
    return add


def of_texts(bins_of: np.ndarray, offs: np.ndarray, form: np.ndarray):
    """Adds text features up, row by row: no matrix of them is made."""
    def add(rows: np.ndarray, to: np.ndarray) -> None:
        for r in rows.tolist():
            n = offs[r + 1] - offs[r]
            if n:
                to[:BINS] += (np.bincount(bins_of[offs[r]:offs[r + 1]], minlength=BINS) / n).astype(np.float32)
        to[BINS:] += form[rows].sum(0)
    return add


def _meta_rows(batch: pa.RecordBatch, names: list[str]) -> list[tuple]:
    return list(zip(*(batch.column(n).to_pylist() for n in names))) if names else [()] * batch.num_rows


def _add_up(block: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x) for x in block["x"].to_pylist()], 0)
    return pa.table({"key": block["key"].slice(0, 1), "part": pa.array([block["part"][0].as_py() // FAN_IN], pa.int32()),
                     "n": pa.array([float(np.sum(block["n"].to_numpy()))]), "x": pa.array([total.tobytes()], pa.binary())})


_SUMS = "key int, part int, n double, x binary"


def judged(batches, views: list[tuple[Logistic, tuple]], slots: list[str]) -> Sums:
    """Sums of the features of the rows that a view is sure of."""
    (t, _), (m, _) = views
    sums = Sums(WIDTHS)
    for batch in batches:
        data, offs = text_buffer(batch.column("text"))
        facts, kind = meta_kinds(_meta_rows(batch, slots), slots)
        of_facts = m.margins(facts)[:, 0]
        groups = batch.column("group").to_numpy()
        for i, j, part, at in text_chunks(data, offs):
            bins, form = gram_bins(part, at, _RAW, GRAM, BINS), shape(part, at)
            margin = (row_means(t.weights[:BINS], bins, at) + form @ t.weights[BINS:] + t.bias)[:, 0]
            classes = confident(views, [margin, of_facts[kind[i:j]]])
            sums.add([of_texts(bins, at, form), of_kinds(facts, kind[i:j])], classes, groups[i:j])
    return sums


def exchange_over(rows: DataFrame, slots: list[str]):
    """The exchange of pseudo-labels over all ``rows`` (text, group, slots)."""
    spark = rows.sparkSession

    def exchange(fitted):
        model = spark.sparkContext.broadcast(fitted)

        def judge(batches):
            found = judged(batches, model.value, slots).rows()
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"key": pa.array([r[0] for r in found], pa.int32()),
                                              "part": pa.array([part] * len(found), pa.int32()),
                                              "n": pa.array([r[1] for r in found], pa.float64()),
                                              "x": pa.array([r[2] for r in found], pa.binary())})

        sums = rows.mapInArrow(judge, _SUMS)
        for _ in range(3):  # FAN_IN ** 3 tasks
            sums = sums.groupBy("key", F.expr(f"part div {FAN_IN}")).applyInArrow(_add_up, _SUMS)
        total = Sums(WIDTHS)
        for r in sums.collect():  # a row per view, class and group
            total.put(r.key, r.n, bytes(r.x))
        return total.means()

    return exchange


def fit(docs: DataFrame, labels: DataFrame, meta: list[str], id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", labelled_rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> Views | None:
    """Fit on the labels (null labels and ids are left out, an id with several
    labels counts by their mean) and all other documents."""
    ship_package(docs.sparkSession)
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("id is not null and y is not null")
             .groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    known = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct().join(marks, "id")
    # About twice the sample meets in one place.
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    n_known = known.count()
    share = min(1 << 30, 1024 + (2 * labelled_rows << 30) // max(n_known, 1))
    chosen = known.where(place < share).orderBy(place, "id").limit(labelled_rows)
    chosen = docs.sparkSession.createDataFrame(chosen.collect(), known.schema)  # at most labelled_rows ids
    # Columns by place, whatever the metadata are called.
    slots = [f"m{k}" for k in range(len(meta))]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *(F.col(c).alias(s) for c, s in zip(meta, slots)))
    own = F.struct("text", *slots)
    sample = (rows.join(F.broadcast(chosen), "id").groupBy("id", "y")
              .agg(F.min_by(own, F.xxhash64("text", *slots)).alias("own")).select("id", "y", "own.*"))

    def features(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column("text"))
            facts = meta_features(_meta_rows(batch, slots), slots)
            for i, j, part, at in text_chunks(data, offs):
                x = _text_features(part, at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i).cast(pa.string()), batch.column("y").slice(i, j - i),
                     pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in facts[i:j]], pa.binary())], names=["id", "y", "text", "meta"])

    sample = sample.mapInArrow(features, "id string, y int, text binary, meta binary").collect()
    sample.sort(key=lambda r: (zlib.crc32(r.id.encode()), r.id))
    if not sample:
        return None
    others = rows.join(F.broadcast(chosen.select("id")), "id", "left_anti").select(
        "text", *slots, F.pmod(F.xxhash64("text"), F.lit(GROUPS)).cast("int").alias("group"))
    wide = BINS + SHAPE
    return cotrain(np.frombuffer(b"".join(r.text for r in sample), np.float32).reshape(-1, wide),
                   np.frombuffer(b"".join(r.meta for r in sample), np.float32).reshape(-1, META_BINS),
                   np.array([r.y for r in sample]), meta, rounds, exchange_over(others, slots))


def score(docs: DataFrame, views: Views | None, text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """``docs`` with ``text_score``, ``meta_score``, ``quality_score`` (each a
    probability of good quality) and ``kept`` (the last is at least ``keep``).

    Without a fit (no labels, or of one class only) the scores are null and
    every row is kept.  Null and empty texts are scored like any other, as
    texts without characters; a null metadata value is a value of its own.
    Columns named like the new ones are replaced."""
    new = {"text_score": T.DoubleType(), "meta_score": T.DoubleType(), "quality_score": T.DoubleType(),
           "kept": T.BooleanType()}
    docs = docs.drop(*new)
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(views)

    def run(batches):
        found = model.value
        for batch in batches:
            data, offs = text_buffer(batch.column(text_col))
            for i, j, part, at in text_chunks(data, offs):
                rows = batch.slice(i, j - i)
                if found is None:
                    none = pa.nulls(j - i, pa.float64())
                    out = [none, none, none, pa.array([True] * (j - i))]
                else:
                    w = found.text.weights
                    margin = (row_means(w[:BINS], gram_bins(part, at, _RAW, GRAM, BINS), at)
                              + shape(part, at) @ w[BINS:] + found.text.bias)[:, 0]
                    facts, kind = meta_kinds(_meta_rows(rows, found.names), [f"m{k}" for k in range(len(found.names))])
                    scores = found.scores(margin, found.meta.margins(facts)[kind, 0])
                    out = [*(pa.array(s, pa.float64()) for s in scores), pa.array(scores[2] >= keep)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *out], names=[*batch.schema.names, *new])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(c, t) for c, t in new.items())]))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents (``op9``)."""
    meta = ["source", "lang", "n_chars"]
    views = fit(docs, labels, meta)
    return score(docs.select("doc_id", "text", *meta), views).select("doc_id", "text_score", "meta_score",
                                                                      "quality_score", "kept")
