"""Benchmark decontamination by an FM-index per shard of training text.

Each task cuts its documents into shards, builds an FM-index (suffix array,
Burrows-Wheeler transform, wavelet matrix) over the shard's words, searches
all benchmark phrases backwards through wavelet ranks, locates the occurrences
by sampled suffix positions and merges them into removal spans.  Documents are
never shuffled.

A phrase is a window of ``window`` consecutive words of a benchmark item; an
item of fewer words, but not none, is one phrase.  Words outside the phrases'
vocabulary cannot be part of an occurrence: they are breaks in the indexed
text, and stretches between breaks that are shorter than the shortest phrase
are not indexed.  That is exact and leaves a small index.

Phrases travel to the tasks in blocks of at most ``block_bytes`` of item text
(a checked bound); a benchmark above it is searched block by block, each
block over all documents, and the spans of the blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import byte_table, chunks, ship_package, text_buffer, word_hashes, words

WINDOW = 13
BLOCK_BYTES = 8 << 20
SAMPLE_EVERY = 8  # one stored suffix position in so many words
# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
WORD_TABLE = byte_table({*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)})

SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("start_word", "end_word", "start_char", "end_char")])


class Phrases:
    """Distinct windows of a block of items: word ids (1 up), by window, and
    the items that hold each window."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        rows, owners = [], []
        for k, (_, text) in enumerate(items):
            h = word_hashes(text, WORD_TABLE)
            size = min(window, len(h))
            for i in range(len(h) - size + 1 if size else 0):
                rows.append(h[i:i + size].tobytes())
                owners.append(k)
        self.names = [name for name, _ in items]
        distinct = {w: i for i, w in enumerate(dict.fromkeys(rows))}
        pairs = sorted({(distinct[w], k) for w, k in zip(rows, owners)})
        self.owner = np.array([k for _, k in pairs], np.int64)
        self.owner_from = np.searchsorted([w for w, _ in pairs], np.arange(len(distinct) + 1))
        self.length = np.array([len(w) // 8 for w in distinct], np.int64)
        self.vocabulary = np.unique(np.frombuffer(b"".join(distinct), np.uint64))
        self.words = np.zeros((len(distinct), int(self.length.max(initial=1))), np.int64)
        for w, i in distinct.items():
            self.words[i, :len(w) // 8] = np.searchsorted(self.vocabulary, np.frombuffer(w, np.uint64)) + 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  Breaks (0) are all different, in
    order of position, so no comparison runs past a break."""
    n = len(text)
    breaks = text == 0
    n_breaks = int(breaks.sum())
    rank = np.where(breaks, np.cumsum(breaks) - 1, text + n_breaks - 1).astype(np.int64)
    step = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[:n - step] = rank[step:] + 1
        key = rank * np.int64(int(rank.max()) + 2 if n else 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        if n == 0 or new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2


class WaveletMatrix:
    """Rank and access over a sequence of symbols, one bit plane per level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = ((symbols >> level) & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` arrives below all levels along ``symbol``."""
        for k, level in enumerate(reversed(range(self.levels))):
            ones = self.ones[k][at].astype(np.int64)
            at = np.where((symbol >> level) & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``."""
        return self.descend(symbol, at) - self.descend(symbol, np.zeros_like(at))


class FMIndex:
    """Full-text index of one shard: ``count`` and ``locate`` word patterns."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample_every: int = SAMPLE_EVERY):
        sa = suffix_array(text)
        self.bwt = text[sa - 1]
        self.tree = WaveletMatrix(self.bwt, n_symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        # Sampled positions: first words of stretches (no walk crosses a
        # break) and every so many words after them.
        breaks = np.flatnonzero(text == 0)
        stretch = np.searchsorted(breaks, np.arange(len(text)), "right") - 1
        since = np.arange(len(text)) - np.where(stretch >= 0, breaks[np.maximum(stretch, 0)], -1) - 1
        marked = (since % sample_every == 0)[sa]
        self.marked, self.sample_no = marked, np.cumsum(marked) - 1
        self.samples = sa[marked]

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array range of every pattern, by backward search."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), len(self.bwt), np.int64)
        for k in reversed(range(patterns.shape[1])):
            act = np.flatnonzero((k < length) & (lo < hi))
            if len(act):
                c = patterns[act, k]
                lo[act] = self.before[c] + self.tree.rank(c, lo[act])
                hi[act] = self.before[c] + self.tree.rank(c, hi[act])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows: walk back to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.flatnonzero(~self.marked[rows])
        while len(open_):
            c = self.bwt[rows[open_]]
            rows[open_] = self.before[c] + self.tree.rank(c, rows[open_])
            steps[open_] += 1
            open_ = open_[~self.marked[rows[open_]]]
        return self.samples[self.sample_no[rows]] + steps


def shard_hits(phrases: Phrases, hashes: np.ndarray, by_row: np.ndarray):
    """Occurrences in one shard: (word position, length, window) arrays.

    ``hashes``: words of the shard; ``by_row``: word offsets by document."""
    none = np.zeros(0, np.int64)
    if not len(phrases.length) or not len(hashes):
        return none, none, none
    at = np.searchsorted(phrases.vocabulary, hashes)
    at[at == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[at] == hashes
    # Stretches of known words within a document.
    first = np.zeros(len(hashes) + 1, bool)
    first[by_row] = True
    begin, finish = known.copy(), known.copy()
    begin[1:] &= ~known[:-1] | first[1:-1]
    finish[:-1] &= ~known[1:] | first[1:-1]
    b, f = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    keep = f - b >= phrases.length.min()
    b, f = b[keep], f[keep]
    if not len(b):
        return none, none, none
    # The indexed text: a break before each stretch and one at the end.
    size = f - b
    text_at = np.cumsum(size + 1) - size  # of each stretch's first word
    text = np.zeros(int((size + 1).sum()) + 1, np.int64)
    inside = np.repeat(text_at - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    source = np.repeat(b - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    text[inside] = at[source] + 1
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.words, phrases.length)
    n = hi - lo
    window = np.repeat(np.arange(len(n)), n)
    rows = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    place = index.locate(rows)
    stretch = np.searchsorted(text_at, place, "right") - 1
    return b[stretch] + place - text_at[stretch], phrases.length[window], window


def _merge(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[list[int]] = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1][1], out[-1][3] = s[1], s[3]
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


_SPAN_KEYS = ("start_word", "end_word", "start_char", "end_char")
_ADDED = {"n_words": pa.int64(), "spans": pa.list_(pa.struct([(k, pa.int64()) for k in _SPAN_KEYS])),
          "items": pa.list_(pa.string())}


def _scan(phrases_of, text_col: str):
    """mapInArrow body: adds one block's spans and items to each row."""

    def scan(batches):
        phrases = phrases_of.value
        for batch in batches:
            data, offs = text_buffer(batch.column(text_col))
            n_words, spans, items = [], [], []
            for i, j in chunks(offs):
                part, part_offs = data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                s, e, h, by_row = words(part, part_offs, WORD_TABLE)
                at, size, window = shard_hits(phrases, h, by_row)
                n_words += (by_row[1:] - by_row[:-1]).tolist()
                row_spans = [[] for _ in range(i, j)]
                row_items = [[] for _ in range(i, j)]
                if len(at):
                    row = np.searchsorted(by_row, at, "right") - 1
                    _collect(phrases, part, part_offs, s, e, by_row, at, size, window, row, row_spans, row_items)
                spans += row_spans
                items += row_items
            if "spans" in batch.schema.names:
                old = [batch.column(c).to_pylist() for c in ("spans", "items")]
                spans = [_merge([tuple(x.values()) for x in a] + b) for a, b in zip(old[0], spans)]
                items = [sorted({*a, *b}) for a, b in zip(old[1], items)]
            new = {"n_words": n_words, "spans": [[dict(zip(_SPAN_KEYS, x)) for x in row] for row in spans], "items": items}
            old = [f for f in batch.schema if f.name not in new]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in old] + [pa.array(new[c], t) for c, t in _ADDED.items()],
                schema=pa.schema(old + [pa.field(c, t) for c, t in _ADDED.items()]))

    return scan


def _collect(phrases, data, offs, s, e, by_row, at, size, window, row, row_spans, row_items) -> None:
    """Merged spans and item names of the rows of one shard that have hits."""
    order = np.argsort(at, kind="stable")
    a, z, r = at[order], (at + size)[order], row[order]
    reach = np.maximum.accumulate(z)
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] > reach[:-1]) | (r[1:] != r[:-1])
    from_, to = a[new], reach[np.append(np.flatnonzero(new)[1:], len(a)) - 1]
    for k, (w0, w1, d) in enumerate(zip(from_.tolist(), to.tolist(), r[new].tolist())):
        text = data[offs[d]:e[w1 - 1]]
        begins = (text & 0xC0) != 0x80  # one per character
        start = int(begins[:s[w0] - offs[d]].sum())
        row_spans[d].append((int(w0 - by_row[d]), int(w1 - by_row[d]), start, int(begins.sum())))
    for d, w in np.unique(np.stack((row, window), 1), axis=0).tolist():
        row_items[d] += phrases.owner[phrases.owner_from[w]:phrases.owner_from[w + 1]].tolist()
    for d in np.unique(row).tolist():
        row_items[d] = sorted({phrases.names[k] for k in row_items[d]})


def contamination_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (all columns) with ``n_words`` long, ``spans``
    array<struct<start_word, end_word, start_char, end_char>> (merged, ends
    exclusive, characters of the original text) and ``items`` array<string>
    (sorted ids of items with an occurring window).

    A null or wordless text has no words and no spans; null or wordless items
    have no phrases; repeated rows and items count as they stand; columns of
    ``docs`` named like the three new ones are replaced."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.drop("n_words", "spans", "items")
    item = items.select(F.col(item_id_col).cast("string").alias("id"), F.col(item_text_col).alias("text")) \
        .where("id is not null and text is not null")
    total = item.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block_of = F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks))
    for block in range(n_blocks):
        rows = item.where(block_of == block).collect()
        phrases = spark.sparkContext.broadcast(Phrases([(r.id, r.text) for r in rows], window))
        out = T.StructType([f for f in docs.schema.fields if f.name not in ("n_words", "spans", "items")]
                           + [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
                              T.StructField("items", T.ArrayType(T.StringType()))])
        docs = docs.mapInArrow(_scan(phrases, text_col), out)
    return docs


def hit_words(spans: str = "spans") -> F.Column:
    """Number of words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["start_word"])


def is_contaminated(n_words: F.Column, n_hit: F.Column) -> F.Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_spans(text: str = "text", spans: str = "spans") -> F.Column:
    """The text with its removal spans cut out."""
    cut = F.aggregate(
        spans, F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(F.concat(a["kept"], F.substring(F.col(text), (a["at"] + 1).cast("int"),
                                                              (s["start_char"] - a["at"]).cast("int"))).alias("kept"),
                              s["end_char"].alias("at")))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(
        F.concat(cut["kept"], F.substring(F.col(text), (cut["at"] + 1).cast("int"), F.length(text))))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One digest row per document (the ``op4`` contract)."""
    found = contamination_spans(docs.select("doc_id", "text"), items, **options)
    n_hit = hit_words()
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated(F.col("n_words"), n_hit).alias("contaminated"))
