"""BPE encoding and decoding with a transducer lexicon.

Frequent pre-tokens of the whole corpus are compiled, with their ids as
outputs, into a minimal acyclic transducer: words that share suffixes share
states, and every transition adds a number, so that a word's sum is its place
in the table of id sequences.  The file is shipped to every executor and
memory-mapped by its tasks.  Words that the lexicon doesn't hold are merged
exactly, pair by pair in merge order.

The model file (path parameter) is a byte-level BPE in the JSON format of the
tokenizers library.  Its data are fixed values; nothing is trained here.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import struct
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.common import chunks, ship_package, stored, text_buffer, work_folder
from basketflow.llm.wordids import WordIds

# The public byte-level pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bound of the lexicon (words) and of a word in it (bytes): with the file's
# merges, a few MB whatever the size of the corpus.
LEXICON_WORDS = 65_536
LEXICON_WORD_BYTES = 48
MEMORY_WORDS = 200_000  # words that a task remembers besides the lexicon
COUNTED_WORDS = 300_000  # words that a task counts before it hands them on


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the model file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(shown))
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class Model:
    """Merges by id pair, bytes by id, and the special strings."""

    def __init__(self, rank: dict[int, int], made: list[int], token: list[bytes], special: dict[str, int]):
        """``rank``: of a pair (a << 32 | b); ``made``: its id, by rank."""
        self.rank, self.made, self.token, self.special = rank, made, token, special
        ids = {t: i for i, t in enumerate(token) if len(t) == 1}
        self.single = [ids[bytes([b])] for b in range(256)]
        names = sorted(special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    @classmethod
    def load(cls, path: str) -> "Model":
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = byte_characters()
        vocab = spec["model"]["vocab"]
        token = [b""] * (1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])]))
        for text, i in vocab.items():
            token[i] = bytes(byte_of[c] for c in text)
        special = {}
        for a in spec["added_tokens"]:
            if a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]:
                raise ValueError(f"special token with unsupported options: {a['content']}")
            special[a["content"]] = a["id"]
            token[a["id"]] = a["content"].encode()
        if spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False,
                                                           "trim_offsets": True, "use_regex": True}:
            raise ValueError("not a plain byte-level BPE")
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in spec["model"]["merges"]]
        rank = {vocab[a] << 32 | vocab[b]: k for k, (a, b) in enumerate(pairs)}
        return cls(rank, [vocab[a + b] for a, b in pairs], token, special)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank, leftmost first, is
        merged until none is left (a heap of pairs over a linked list)."""
        ids = [self.single[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        if n <= 24:
            return self._merge_short(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (rank := self.rank.get(ids[i] << 32 | ids[after[i]])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [i for i in ids if i >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank, made, none = self.rank, self.made, 1 << 60
        ranks = [rank.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while (best := min(ranks, default=none)) != none:
            k = ranks.index(best)  # leftmost
            ids[k] = new = made[best]
            del ids[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank.get(ids[k - 1] << 32 | new, none)
            if k < len(ranks):
                ranks[k] = rank.get(new << 32 | ids[k + 1], none)
        return ids


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Minimal acyclic automaton of sorted distinct words: (transitions by
    state, accepting), state 0 first.  Built word by word; a state is shared
    as soon as an equal one (same end, same transitions) exists."""
    next_: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    free: list[int] = []
    register: dict[tuple, int] = {}
    path = [0]
    previous = b""

    def settle(depth: int) -> None:
        while len(path) - 1 > depth:
            state = path.pop()
            label = previous[len(path) - 1]
            key = (final[state], tuple(next_[state].items()))
            same = register.setdefault(key, state)
            if same != state:
                next_[path[-1]][label] = same
                free.append(state)

    for word in words:
        common = len(os.path.commonprefix((previous, word)))
        settle(common)
        for b in word[common:]:
            if free:
                state = free.pop()
                next_[state], final[state] = {}, False
            else:
                state = len(next_)
                next_.append({})
                final.append(False)
            next_[path[-1]][b] = state
            path.append(state)
        final[path[-1]] = True
        previous = word
    settle(0)
    return next_, final


_FILE = ("key", "to", "add", "final", "first", "ids", "pair", "rank", "made", "token_from",
         "token")
_TYPES = {"key": np.int64, "to": np.int32, "add": np.int32, "final": np.uint8, "first": np.int64, "ids": np.uint32,
          "pair": np.int64, "rank": np.int32, "made": np.int32, "token_from": np.int64, "token": np.uint8}


def write_lexicon(path: str, words: list[str], model: Model) -> None:
    """Compile ``words`` into the transducer file."""
    coded = sorted({w.encode("utf-8") for w in words})
    next_, final = minimal_automaton(coded)
    below: dict[int, int] = {}  # words accepted from a state on

    def count(state: int) -> int:
        stack = [state]
        while stack:
            s = stack[-1]
            todo = [t for t in next_[s].values() if t not in below]
            if todo:
                stack += todo
            else:
                below[s] = final[s] + sum(below[t] for t in next_[s].values())
                stack.pop()
        return below[state]

    count(0)
    edges = []
    for s in below:
        add = int(final[s])
        for b, t in sorted(next_[s].items()):
            edges.append((s << 8 | b, t, add))
            add += below[t]
    edges.sort()
    ids = [model.merge(w) for w in coded]
    arrays = {"key": [e[0] for e in edges], "to": [e[1] for e in edges], "add": [e[2] for e in edges], "final": final,
              "first": np.cumsum([0] + [len(x) for x in ids]), "ids": [i for x in ids for i in x],
              "pair": list(model.rank), "rank": list(model.rank.values()), "made": model.made,
              "token_from": np.cumsum([0] + [len(t) for t in model.token]),
              "token": np.frombuffer(b"".join(model.token), np.uint8)}
    arrays = {k: np.asarray(arrays[k], _TYPES[k]) for k in _FILE}
    special = json.dumps(model.special).encode()
    with open(path, "wb") as f:
        f.write(struct.pack(f"<{len(_FILE) + 1}q", *(len(arrays[k]) for k in _FILE), len(special)))
        for k in _FILE:
            f.write(arrays[k].tobytes() + bytes(-arrays[k].nbytes % 8))
        f.write(special)


class Lexicon:
    """The memory-mapped file: lookup, exact merges and token bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            sizes = struct.unpack(f"<{len(_FILE) + 1}q", f.read(8 * (len(_FILE) + 1)))
            at = f.tell()
            for k, n in zip(_FILE, sizes):
                a = np.memmap(path, _TYPES[k], "r", at, (n,)) if n else np.zeros(0, _TYPES[k])
                setattr(self, k, a)
                at += n * np.dtype(_TYPES[k]).itemsize + -n * np.dtype(_TYPES[k]).itemsize % 8
            f.seek(at)
            special = json.loads(f.read(sizes[-1]))
        ends = self.token_from.tolist()
        data = self.token.tobytes()
        self.model = Model(dict(zip(self.pair.tolist(), self.rank.tolist())), self.made.tolist(),
                           [data[a:b] for a, b in zip(ends, ends[1:])], special)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Place of every word in the lexicon, or -1: all words walk through
        the transducer together, one byte at a time, adding its numbers."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        state, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = np.arange(n)
        for k in range(int(size.max(initial=0))):
            live = live[size[live] > k]
            if not len(live):
                break
            key = state[live] << 8 | data[begin[live] + k]
            at = np.searchsorted(self.key, key)
            at[at == len(self.key)] = 0
            known = self.key[at] == key if len(self.key) else np.zeros(len(key), bool)
            place[live[~known]] = -1
            live, at = live[known], at[known]
            state[live] = self.to[at]
            place[live] += self.add[at]
        place[(place >= 0) & (self.final[state] == 0)] = -1
        return place

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and the number of each."""
        special, merge = self.model.special, self.model.merge
        coded = [w.encode("utf-8") for w in words]
        first, known = self.first, self.ids
        out: list[int] = []
        ends = []
        for w, b, place in zip(words, coded, self.find(coded).tolist()):
            if w in special:
                out.append(special[w])
            elif place >= 0:
                out += known[first[place]:first[place + 1]].tolist()
            else:
                out += merge(b)
            ends.append(len(out))
        return np.array(out, np.uint32), np.diff(ends, prepend=0)


_SPLIT = regex.compile(PATTERN)
# The same pattern for ASCII text, where the standard module is faster.
_SPLIT_ASCII = re.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)


def _split(text: str) -> list[str]:
    return _SPLIT_ASCII.findall(text) if text.isascii() else _SPLIT.findall(text)


def pre_tokens(text: str, special_pattern=None) -> list[str]:
    """Pre-tokens in order; special strings stand alone."""
    if special_pattern is None or not special_pattern.search(text):
        return _split(text)
    out = []
    for k, part in enumerate(special_pattern.split(text)):
        out += [part] if k % 2 else _split(part)
    return out


def word_counts(docs: DataFrame, text_col: str, model: Model, held: int = COUNTED_WORDS) -> DataFrame:
    """(word, n) of all pre-tokens of all texts; each task sums its own words
    before the shuffle, up to about ``held`` at a time."""
    special = model.special_pattern

    def count(batches):
        tally: Counter[str] = Counter()

        def rows():
            out = pa.RecordBatch.from_pydict({"word": pa.array(list(tally), pa.string()),
                                              "n": pa.array(list(tally.values()), pa.int64())})
            tally.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                tally.update(pre_tokens(text.as_py() or "", special))
                if len(tally) > held:
                    yield rows()
        yield rows()

    return (docs.select(text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def most_frequent(counts: DataFrame, n_words: int) -> DataFrame:
    """The words of ``counts`` (word, n) above a least count, at most
    ``n_words``.  The least count comes from a histogram of the counts in
    steps of an eighth of a doubling (a few hundred rows), so no task and no
    driver ever holds the best words of all tasks; of the step that would go
    beyond ``n_words`` none is taken."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for s in steps:
        taken += s.words
        if taken > n_words:
            break
        least = s.step
    return counts.where(step >= least) if least is not None else counts.limit(0)


def build_lexicon(docs: DataFrame, model_path: str, text_col: str = "text", n_words: int = LEXICON_WORDS,
                  held: int = COUNTED_WORDS) -> str:
    """Compile the most frequent words of ``docs`` (at most ``n_words``) and
    ship the file to all executors; returns its name.  ``held`` is for
    ``word_counts``."""
    spark = docs.sparkSession
    ship_package(spark)
    model = Model.load(model_path)
    counts = stored(word_counts(docs, text_col, model, held).where(F.octet_length("word") <= LEXICON_WORD_BYTES),
                    work_folder(spark, "lexicon"))
    top = sorted(most_frequent(counts, n_words).select("word").collect())
    return ship_lexicon(spark, [r.word for r in top if r.word not in model.special], model)


def ship_lexicon(spark, words: list[str], model: Model) -> str:
    folder = tempfile.mkdtemp(prefix="basketflow-lexicon-")  # on the driver; executors get it from Spark
    draft = os.path.join(folder, "lexicon")
    write_lexicon(draft, words, model)
    with open(draft, "rb") as f:
        name = f"lexicon-{hashlib.sha256(f.read()).hexdigest()[:24]}"
    os.rename(draft, os.path.join(folder, name))
    if name not in _SHIPPED.setdefault(spark.sparkContext.applicationId, set()):
        spark.sparkContext.addFile(os.path.join(folder, name))
        _SHIPPED[spark.sparkContext.applicationId].add(name)
    return name


_SHIPPED: dict[str, set[str]] = {}
_OPEN: dict[str, tuple[Lexicon, WordIds]] = {}


def _lexicon(name: str, remember: int = MEMORY_WORDS) -> tuple[Lexicon, WordIds]:
    if name not in _OPEN:
        _OPEN.clear()
        found = Lexicon(SparkFiles.get(name))
        _OPEN[name] = found, WordIds(found.encode_words)
    _OPEN[name][1].limit = remember
    return _OPEN[name]


def encode(docs: DataFrame, lexicon: str, text_col: str = "text", ids_col: str = "ids",
           remember: int = MEMORY_WORDS) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of the whole text as little-endian
    unsigned 32-bit integers (binary).  A null text has no ids; a column of
    that name is replaced.  A task remembers about ``remember`` words: fewer
    take less memory and are merged more often."""
    docs = docs.drop(ids_col)

    def run(batches):
        found, memory = _lexicon(lexicon, remember)
        special = found.model.special_pattern
        for batch in batches:
            column = batch.column(text_col)
            _, offs = text_buffer(column)
            for i, j in chunks(offs):
                texts = column.slice(i, j - i).to_pylist()
                ids, at = memory.encode([pre_tokens(t, special) if t else [] for t in texts])
                coded = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), j - i, [None, pa.py_buffer((at * 4).astype(np.int64)),
                                               pa.py_buffer(ids.astype("<u4"))])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, coded.cast(pa.binary())],
                                                 names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids_col, T.BinaryType())]))


def decode(rows: DataFrame, lexicon: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col``: the text of the ids, special tokens kept;
    bytes that are not UTF-8 become U+FFFD.  Ids that the model doesn't know
    give nothing, null ids an empty text."""
    rows = rows.drop(out_col)

    def run(batches):
        found, _ = _lexicon(lexicon)
        first, data = np.asarray(found.token_from), np.asarray(found.token)
        for batch in batches:
            coded, offs = text_buffer(batch.column(ids_col))
            for i, j in chunks(offs):
                part = batch.slice(i, j - i)
                ids = np.frombuffer(coded[offs[i]:offs[j]].tobytes(), "<u4").astype(np.int64)
                ids[ids >= len(first) - 1] = len(first) - 1
                size = np.append(first[1:] - first[:-1], 0)[ids]
                ends = np.cumsum(size)
                text = data[np.repeat(first[ids] - (ends - size), size) + np.arange(int(size.sum()))].tobytes()
                at = np.concatenate(([0], ends))[(offs[i:j + 1] - offs[i]) // 4].tolist()
                texts = [text[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*batch.schema.names, out_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))


def report(docs: DataFrame, model_path: str) -> DataFrame:
    """One digest row per document (the ``op10`` contract)."""
    docs = docs.select("doc_id", "text")
    lexicon = build_lexicon(docs, model_path)
    both = decode(encode(docs, lexicon).drop("text"), lexicon)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
