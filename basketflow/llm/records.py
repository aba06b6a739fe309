"""Token ids as length-delimited binary record files.

A record file holds frames; a frame is

    length    uint64, bytes of the payload
    checksum  uint32, masked CRC-32C of the length field
    payload
    checksum  uint32, masked CRC-32C of the payload

all little-endian (the framing of TFRecord files).  A payload is one
sequence: 1 byte of flags (bit 0: there is a document id, bit 1: ids of 32
bits), the document id as int64, then the ids as unsigned 16-bit integers, or
32-bit ones if the vocabulary needs them.  Beside each file ``x.rec`` stands ``x.idx``: the byte offset of every frame as uint64, so that
frames can be read in any order.

Documents are range-partitioned by id, encoded and written by the task that
holds the range.  A task attempt writes files with names of its own; the
manifest, which Spark commits, names those of the attempts that succeeded, so
a lost executor or a second attempt leaves no wrong file in use.
"""

from __future__ import annotations

import json
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.common import chunks, ship_package, stored, text_buffer, work_folder
from basketflow.llm.crc32c import crc32c, masked
from basketflow.llm.wordids import WordIds

END_ID = 2
_WIDE = 2  # flag: ids of 32 bits
_READ_BYTES = 4 << 20

# Places where a text may be cut before it is encoded: the tokenizer never
# joins across white space.  str.split() may be used unless the text holds
# white space that only one of the two sides knows.
_SPACE = re.compile(r"[ \t\r\n]+")
_ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

# A word of letters and then marks is two words to a model that splits like
# this.  Only letters that no normaliser changes, and marks that begin nothing.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
_MARKS = r"!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"
_MARKED = re.compile(f"([{_LETTERS}]+)([{_MARKS}]+)")
_PLAIN = re.compile(f"[{_LETTERS}{_MARKS}]*")


def cut(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w] if _ODD_SPACE.search(text) else text.split()


class WordEncoder:
    """Ids of distinct words by the tokenizer, many words in one call.

    Words of letters alone are joined by a line end and told apart by the ids
    that end a word, if the model marks those (the letters a-z by themselves); the others are joined by a
    special token, which then stands between their ids.  A word that holds a
    special token's text goes alone."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = json.loads(model).get("added_tokens", [])
        plain = [a for a in added if a["special"] and not (a["lstrip"] or a["rstrip"] or a["normalized"] or a["single_word"])]
        self.mark, self.mark_id = (plain[0]["content"], plain[0]["id"]) if plain else (None, None)
        self.special = [a["content"] for a in added]
        whole = json.loads(model)
        suffix = whole["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        # A tokenizer that lower-cases gives A-Z and a-z the same ids.
        self.lowers = '"Lowercase"' in json.dumps(whole.get("normalizer"))
        self.splits = self._known_split(whole) and not any(_PLAIN.fullmatch(m) for m in self.special)
        self.plain = None
        if self.splits and self.ends_word.any():
            # Words of the letters a-z alone need no normaliser and no pattern.
            self.plain = Tokenizer.from_str(json.dumps(
                whole | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "truncation": None,
                         "padding": None}))

    @staticmethod
    def _known_split(whole: dict) -> bool:
        def steps(part, name):
            return part.get(name, [part]) if part else []
        made = [n["type"] for n in steps(whole.get("normalizer"), "normalizers")]
        cuts = steps(whole.get("pre_tokenizer"), "pretokenizers")
        spaces = [n for n in steps(whole.get("normalizer"), "normalizers") if n["type"] == "Replace"]
        return (made in (["NFC", "Replace", "Lowercase"], ["NFC", "Lowercase"], ["NFC"], [])
                and all(n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in spaces)
                and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
                and cuts[0]["pattern"] == {"Regex": _SPLIT} and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"]
                and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])

    def words(self, data: bytes, offs: np.ndarray) -> list[list[str]]:
        """Words of the texts that lie end to end in ``data``."""
        marks = [m.encode("utf-8") for m in {m[:2] for m in self.special}]
        cuts = offs.tolist()
        whole = data.lower() if self.lowers else data  # A-Z only: fewer distinct words
        if whole is not data and any(m in data for m in marks):
            whole = b"".join(t if any(m in t for m in marks) else t.lower()
                             for t in (data[a:b] for a, b in zip(cuts, cuts[1:])))
        return [cut(whole[a:b].decode("utf-8")) for a, b in zip(cuts, cuts[1:])]

    def parts(self, words: list[str]) -> dict[int, tuple[str, str]]:
        """By place: two words whose ids end to end are the word's, if known."""
        if not self.splits:
            return {}
        return {k: m.groups() for k, w in enumerate(words) if not w.isalpha() and (m := _MARKED.fullmatch(w))}

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and the number of each."""
        left = list(range(len(words)))
        done: list[tuple[list[int], np.ndarray, np.ndarray]] = []  # words, their ids, number of each
        if self.ends_word.any():
            letters = [k for k in left if words[k].isalpha()]
            easy = [k for k in letters if words[k].isascii() and words[k].islower()] if self.plain else []
            taken = set(easy)
            for own, tokenizer in ((easy, self.plain), ([k for k in letters if k not in taken], self.tokenizer)):
                ids = self._encode("\n".join([words[k] for k in own]), tokenizer) if own else []
                ends = np.flatnonzero(self.ends_word[ids]) + 1 if own else []
                if own and len(ends) == len(own) and ends[-1] == len(ids):
                    done.append((own, ids, np.diff(ends, prepend=0)))
            taken = {k for own, _, _ in done for k in own}
            left = [k for k in left if k not in taken]
        alone = [k for k in left if self.mark is None or any(m in words[k] for m in self.special)]
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([words[k] for k in alone], add_special_tokens=False)):
            done.append(([k], np.array(e.ids, np.uint32), np.array([len(e.ids)])))
        taken = set(alone)
        left = [k for k in left if k not in taken]
        if left:
            ids = self._encode(self.mark.join([*(words[k] for k in left), ""]), self.tokenizer)
            ends = np.flatnonzero(ids == self.mark_id)
            done.append((left, ids[ids != self.mark_id], np.diff(ends, prepend=-1) - 1))
        # Back into the order of the words.
        order = np.argsort(np.concatenate([own for own, _, _ in done]), kind="stable")
        sizes = np.concatenate([size for _, _, size in done])
        start, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(size)
        every = np.concatenate([ids for _, ids, _ in done])
        return every[np.repeat(start - (ends - size), size) + np.arange(len(every))], size

    @staticmethod
    def _encode(text: str, tokenizer) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)


_OPEN: dict[str, tuple[WordEncoder, WordIds]] = {}


def _encoder(model: str) -> tuple[WordEncoder, WordIds]:
    if model not in _OPEN:
        _OPEN.clear()
        words = WordEncoder(model)
        _OPEN[model] = words, WordIds(words.ids, parts=words.parts)
    return _OPEN[model]


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else re.sub("^file:/*", "/", folder)) \
        if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def frames(doc_ids: list[int | None], ids: np.ndarray, at: np.ndarray, wide: bool) -> tuple[bytes, np.ndarray]:
    """The frames of consecutive sequences and the size of each."""
    body = ids.astype("<u4" if wide else "<u2").view(np.uint8)
    width = 4 if wide else 2
    n = len(doc_ids)
    payload = 9 + (at[1:] - at[:-1]) * width
    size = payload + 16
    begin = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)

    def put(place: np.ndarray, values: np.ndarray) -> None:
        cells = values.view(np.uint8).reshape(n, -1)
        out[place[:, None] + np.arange(cells.shape[1])] = cells

    put(begin, payload.astype("<u8"))
    put(begin + 8, masked(crc32c(out, begin, np.full(n, 8, np.int64))).astype("<u4"))
    known = np.fromiter((d is not None for d in doc_ids), bool, n)
    out[begin + 12] = known.astype(np.uint8) | (_WIDE if wide else 0)
    put(begin + 13, np.array([d or 0 for d in doc_ids], "<i8"))
    for place, a, b in zip((begin + 21).tolist(), (at[:-1] * width).tolist(), (at[1:] * width).tolist()):
        out[place:place + b - a] = body[a:b]
    put(begin + 12 + payload, masked(crc32c(out, begin + 12, payload)).astype("<u4"))
    return out.tobytes(), size


def parse(data: np.ndarray, begin: np.ndarray) -> list[tuple[int | None, np.ndarray]]:
    """(document id, ids as uint32) of the frames at ``begin``; a wrong
    length or checksum raises ValueError."""
    n = len(begin)

    def field(place: np.ndarray, kind: str) -> np.ndarray:
        width = np.dtype(kind).itemsize
        return data[place[:, None] + np.arange(width)].reshape(-1).view(kind)

    size = field(begin, "<u8").astype(np.int64)
    if (field(begin + 8, "<u4") != masked(crc32c(data, begin, np.full(n, 8, np.int64)))).any() or \
            (begin + size + 16 > len(data)).any() or \
            (field(begin + 12 + size, "<u4") != masked(crc32c(data, begin + 12, size))).any():
        raise ValueError("record file is damaged")
    flag, doc = data[begin + 12].tolist(), field(begin + 13, "<i8").tolist()
    return [(d if f & 1 else None, data[b + 21:b + 12 + s].view("<u4" if f & _WIDE else "<u2").astype(np.uint32))
            for f, d, b, s in zip(flag, doc, begin.tolist(), size.tolist())]


def frame_starts(data: np.ndarray) -> tuple[list[int], int]:
    """Starts of the whole frames at the head of ``data`` and their end."""
    starts, at, n = [], 0, len(data)
    view = memoryview(data)
    while at + 16 <= n:
        size = struct.unpack_from("<Q", view, at)[0]
        if at + 16 + size > n:
            break
        starts.append(at)
        at += 16 + size
    return starts, at


def largest_id(model: str) -> int:
    """The largest id that a tokenizer model (JSON text) can give."""
    whole = json.loads(model)
    vocab = whole["model"]["vocab"]
    known = vocab.values() if isinstance(vocab, dict) else range(len(vocab))
    return max([0, *known, *(a["id"] for a in whole.get("added_tokens", []))])


MANIFEST = "part int, file string, n_records long, n_ids long, n_bytes long"


def write_records(docs: DataFrame, folder: str, model: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int | None = END_ID) -> DataFrame:
    """Encode the whole texts with the tokenizer ``model`` (JSON text) and
    write them in ascending order of ``id_col`` (nulls first; equal ids by
    text hash).  Returns the stored manifest, one row per file, in order of
    ``part``.  A null text is an empty sequence; ``end_id`` ends each.  Ids are
    stored in 16 bits if the largest one of the model and ``end_id`` fits."""
    spark = docs.sparkSession
    ship_package(spark)
    wide = max(largest_id(model), end_id or 0) >= 1 << 16

    def write(batches):
        encoder, memory = _encoder(model)
        target, path = _filesystem(folder)
        part = TaskContext.get().partitionId()
        name = f"{path}/{part:06d}-{uuid.uuid4().hex}"
        out, places, n_ids, at_byte = None, [], 0, 0
        for batch in batches:
            data, offs = text_buffer(batch.column(1))
            for i, j in chunks(offs):
                ids, at = memory.encode(encoder.words(data[offs[i]:offs[j]].tobytes(), offs[i:j + 1] - offs[i]))
                if end_id is not None:
                    ids = np.insert(ids, at[1:], end_id)
                    at = at + np.arange(len(at))
                coded, size = frames(batch.column(0).slice(i, j - i).to_pylist(), ids, at, wide)
                if out is None:
                    target.create_dir(path, recursive=True)
                    out = target.open_output_stream(f"{name}.rec")
                out.write(coded)
                places.append(at_byte + np.cumsum(size) - size)
                at_byte += len(coded)
                n_ids += len(ids)
        if out is not None:
            out.close()
            index = np.concatenate(places).astype("<u8")
            with target.open_output_stream(f"{name}.idx") as f:
                f.write(index.tobytes())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()),
                                              "file": [name.rsplit("/", 1)[1]],
                                              "n_records": pa.array([len(index)], pa.int64()),
                                              "n_ids": pa.array([n_ids], pa.int64()),
                                              "n_bytes": pa.array([at_byte], pa.int64())})

    tie = F.xxhash64(text_col)
    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), tie.alias("tie"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text"))
    return stored(ordered.mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """All sequences from the files of a manifest: id, ``start`` (ids before
    it in all files), ``record`` (its number in its file), ``ids`` (binary,
    little-endian unsigned 32-bit).  Every frame's checksums are verified."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))
    spark = manifest.sparkSession
    ship_package(spark)
    n_files = manifest.count()

    def read(batches):
        source, path = _filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record, rest = 0, b""
                with source.open_input_stream(f"{path}/{name}.rec") as f:
                    want = _READ_BYTES
                    while True:
                        more = f.read(want)
                        data = np.frombuffer(rest + more, np.uint8)
                        begin, end = frame_starts(data)
                        if begin:
                            found = parse(data, np.array(begin, np.int64))
                            sizes = np.array([len(x) for _, x in found], np.int64)
                            yield pa.RecordBatch.from_pydict({
                                "id": pa.array([d for d, _ in found], pa.int64()),
                                "start": pa.array(start + np.cumsum(sizes) - sizes, pa.int64()),
                                "record": pa.array(range(record, record + len(found)), pa.int64()),
                                "ids": pa.array([x.astype("<u4").tobytes() for _, x in found], pa.binary())})
                            start += int(sizes.sum())
                            record += len(found)
                        rest = data[end:].tobytes()
                        if not more:
                            if rest:
                                raise ValueError(f"record file ends within a frame: {name}")
                            break
                        # a frame larger than a read: fetch it whole at once
                        want = _READ_BYTES if begin else max(_READ_BYTES, len(rest))

    return files.repartition(max(1, n_files), "file").mapInArrow(
        read, "id long, start long, record long, ids binary")


class RecordFile:
    """Random access to one file by its offset index (for shuffled reads)."""

    def __init__(self, folder: str, name: str):
        self.fs, path = _filesystem(folder)
        with self.fs.open_input_stream(f"{path}/{name}.idx") as f:
            self.offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
        self.file = self.fs.open_input_file(f"{path}/{name}.rec")
        self.ends = np.append(self.offsets[1:], self.file.size())

    def __len__(self) -> int:
        return len(self.offsets)

    def __getitem__(self, k: int) -> tuple[int | None, np.ndarray]:
        data = self.file.read_at(int(self.ends[k] - self.offsets[k]), int(self.offsets[k]))
        return parse(np.frombuffer(data, np.uint8), np.zeros(1, np.int64))[0]


def crc_of_ids(rows: DataFrame) -> DataFrame:
    """``n_tokens`` and unsigned crc32 of the ids, from their bytes."""
    return rows.select(F.col("id").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


def report(docs: DataFrame, model_path: str, folder: str | None = None) -> DataFrame:
    """Write the files, read them back: one digest row per document (the
    ``op8`` contract)."""
    spark: SparkSession = docs.sparkSession
    folder = folder or work_folder(spark, "records")
    with open(model_path, encoding="utf-8") as f:
        model = f.read()
    return crc_of_ids(read_records(write_records(docs, folder, model), folder))
