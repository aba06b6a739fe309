import hashlib
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import DOCS, crowded, docs, empty
from conftest import SF_SMALL
from tokenizers import Tokenizer

from basketflow.llm import bpe, queries, records
from basketflow.llm.crc32c import crc32c, masked

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def little(ids):
    return np.array(ids, "<u4").tobytes()


def test_checksums():
    data = np.frombuffer(b"123456789" + bytes(32) + bytes(range(256)) * 3, np.uint8)
    got = crc32c(data, np.array([0, 9, 5]), np.array([9, 32, 0]))
    assert got.tolist() == [0xE3069283, 0x8A9136AA, 0]  # published check values

    def plain(b):
        c = 0xFFFFFFFF
        for x in b:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF
    spans = [(a, n) for a in (0, 7, 41) for n in (1, 8, 63, 64, 65, 200, 500)]
    got = crc32c(data, np.array([a for a, _ in spans]), np.array([n for _, n in spans]))
    assert got.tolist() == [plain(data[a:a + n].tobytes()) for a, n in spans]
    assert masked(np.array([0], np.uint32)).tolist() == [0xA282EAD8]


def test_record_files_hold_what_the_library_gives(spark):
    rows = queries.queries()["op8_record_files"](spark, SF_SMALL).collect()
    source = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [r.doc_id for r in source]
    start = 0
    by = {r.doc_id: r for r in rows}
    for doc, ids in zip(source, library(WORD, [r.text for r in source])):
        ids = ids + [2]
        r = by[doc.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(little(ids)))
        start += len(ids)


def test_record_files_awkward_rows_random_access_and_damage(spark, tmp_path):
    folder = str(tmp_path / "rec")
    with open(WORD, encoding="utf-8") as f:
        manifest = records.write_records(crowded(docs(spark)), folder, f.read())
    found = records.read_records(manifest, folder).collect()
    want = {t: ids + [2] for t, ids in zip([d[1] for d in DOCS], library(WORD, [d[1] for d in DOCS]))}
    assert sorted((r.id is not None, r.id or 0, bytes(r.ids)) for r in found) == sorted(
        (d[0] is not None, d[0] or 0, little(want[d[1]])) for d in DOCS)
    assert [r.id for r in sorted(found, key=lambda r: r.start)] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    some = manifest.collect()[0]
    file = records.RecordFile(folder, some.file)
    assert len(file) == some.n_records
    by_place = {(r.id, bytes(r.ids)) for r in found}
    for k in random.sample(range(len(file)), len(file)):
        doc, ids = file[k]
        assert (doc, little(ids)) in by_place
    path = f"{folder}/{some.file}.rec"
    raw = bytearray(open(path, "rb").read())
    raw[-6] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="damaged"):
        records.read_records(manifest, folder).collect()
    open(path, "wb").write(raw[:-3])
    with pytest.raises(Exception, match="ends within"):
        records.read_records(manifest, folder).collect()


def test_record_files_empty_table_and_wide_ids(spark, tmp_path):
    with open(WORD, encoding="utf-8") as f:
        model = f.read()
    manifest = records.write_records(empty(spark), str(tmp_path / "none"), model)
    assert manifest.count() == 0 and records.read_records(manifest, str(tmp_path / "none")).count() == 0
    coded, size = records.frames([5, None], np.array([70000, 1, 2], np.uint32), np.array([0, 1, 3]), True)
    data = np.frombuffer(coded, np.uint8)
    starts, end = records.frame_starts(data)
    assert end == len(data) and size.sum() == end
    assert [(d, x.tolist()) for d, x in records.parse(data, np.array(starts))] == [(5, [70000]), (None, [1, 2])]


def test_bpe_equals_the_library(spark):
    rows = queries.queries()["op10_bpe_transducer"](spark, SF_SMALL).collect()
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    t = Tokenizer.from_file(BYTE)
    assert len(rows) == len(source)
    for r in rows:
        ids = t.encode(source[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(little(ids)).hexdigest())
        text = t.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_awkward_rows(spark):
    frame = crowded(docs(spark))
    for n_words in (0, 3, 1000):  # nothing, little or all in the lexicon
        lexicon = bpe.build_lexicon(frame, BYTE, n_words=max(1, n_words)) if n_words else \
            bpe.ship_lexicon(spark, [], bpe.Model.load(BYTE))
        both = bpe.decode(bpe.encode(frame, lexicon), lexicon).select("text", "ids", "decoded").collect()
        want = dict(zip([d[1] for d in DOCS], library(BYTE, [d[1] for d in DOCS])))
        assert len(both) == len(DOCS)
        assert all(bytes(r.ids) == little(want[r.text]) and r.decoded == (r.text or "") for r in both)
    assert bpe.report(empty(spark), BYTE).count() == 0


def test_decode_of_any_ids(spark):
    t = Tokenizer.from_file(BYTE)
    random.seed(2)
    rows = [(k, bytearray(little([random.randrange(50257) for _ in range(n)]))) for k, n in enumerate([0, 1, 5, 300] * 5)]
    lexicon = bpe.ship_lexicon(spark, ["a", " the"], bpe.Model.load(BYTE))
    frame = spark.createDataFrame([*rows, (99, None)], "k long, ids binary")
    for r in bpe.decode(frame, lexicon).collect():
        ids = np.frombuffer(r.ids or b"", "<u4").tolist()
        assert r.decoded == t.decode(ids, skip_special_tokens=False)


def test_automaton_is_minimal_and_counts_places(tmp_path):
    random.seed(4)
    words = sorted({"".join(random.choices("abc", k=random.randint(1, 6))) for _ in range(300)})
    next_, final = bpe.minimal_automaton([w.encode() for w in words])
    live, todo = set(), [0]
    while todo:
        s = todo.pop()
        if s not in live:
            live.add(s)
            todo += next_[s].values()

    def language(s):
        return frozenset([""] * final[s]) | {chr(b) + w for b, t in next_[s].items() for w in language(t)}
    assert language(0) == set(words)
    assert len({language(s) for s in live}) == len(live)  # no two states accept the same
    bpe.write_lexicon(str(tmp_path / "lex"), words, bpe.Model.load(BYTE))
    lexicon = bpe.Lexicon(str(tmp_path / "lex"))
    probe = ["".join(random.choices("abcd", k=random.randint(1, 7))) for _ in range(500)] + words
    assert lexicon.find([w.encode() for w in probe]).tolist() == [
        words.index(w) if w in words else -1 for w in probe]


def test_long_merges_equal_short_ones():
    model = bpe.Model.load(BYTE)
    t = Tokenizer.from_file(BYTE)
    random.seed(8)
    for n in (25, 26, 100, 2000):
        w = "".join(random.choices("etaoinshrdlu", k=n))
        assert model.merge(w.encode()) == t.encode(w).ids


def test_most_frequent_words_by_a_histogram(spark):
    counts = spark.createDataFrame([(f"w{k}", 1 + 4000 // (k + 1)) for k in range(3000)], "word string, n long")
    for n_words in (1, 10, 500, 2999, 3000, 10_000):
        got = {r.word for r in bpe.most_frequent(counts, n_words).collect()}
        assert len(got) <= n_words and (n_words < 3000 or len(got) == 3000)
        assert got == {f"w{k}" for k in range(len(got))}  # the most frequent ones
        if 10 <= n_words < 1000:
            assert len(got) > n_words * 0.7
    assert bpe.most_frequent(counts.limit(0), 5).count() == 0


def test_width_of_ids_follows_the_model(spark, tmp_path):
    """A model with ids above 65,535 is stored in 32 bits, without being told."""
    model = json.dumps({"version": "1.0", "added_tokens": [], "normalizer": None,
                        "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
                        "model": {"type": "WordLevel", "vocab": {"<pad>": 0, "a": 70_001, "b": 3}, "unk_token": "<pad>"}})
    assert records.largest_id(model) == 70_001 and records.largest_id(open(WORD).read()) < 1 << 16
    frame = docs(spark, [(1, "a b a", "en", "s", 5)])
    folder = str(tmp_path / "rec")
    back = records.read_records(records.write_records(frame, folder, model), folder).collect()
    assert np.frombuffer(back[0].ids, "<u4").tolist() == [70_001, 3, 70_001, 2]


def test_few_words_held_change_no_result(spark, monkeypatch):
    import corpus_pipeline
    texts = ["the cat, the dog 12 cats", None, "", "the\u00e9 <|endoftext|> cat don't", "a b c d e f g the cat"]
    frame = docs(spark, [(k, t, "en", "s", 5) for k, t in enumerate(texts)]).coalesce(1)
    model = bpe.Model.load(BYTE)
    whole, few = ({r.word: r.n for r in bpe.word_counts(frame, "text", model, held).collect()} for held in (10**6, 2))
    assert whole == few and len(few) > 10
    lexicon = bpe.build_lexicon(frame, BYTE, n_words=3, held=2)
    got = {r.doc_id: bytes(r.ids) for r in bpe.encode(frame, lexicon, remember=2).collect()}
    assert got == {k: little(ids) for k, ids in enumerate(library(BYTE, texts))}
    # The pipeline's workers, which live through all stages, hold few.
    seen = {}
    build, encode = bpe.build_lexicon, bpe.encode
    monkeypatch.setattr(bpe, "build_lexicon", lambda *a, **k: (seen.update(k), build(*a, **k))[1])
    monkeypatch.setattr(bpe, "encode", lambda *a, **k: (seen.update(k), encode(*a, **k))[1])
    rows = corpus_pipeline.tokens(spark, frame, "")
    assert {r.doc_id: bytes(r.ids) for r in rows.collect()} == got
    assert seen["held"] == seen["remember"] == corpus_pipeline.HELD_WORDS < bpe.MEMORY_WORDS


def test_words_with_marks_are_put_together_from_known_words():
    from basketflow.llm.wordids import WordIds
    with open(WORD, encoding="utf-8") as f:
        encoder = records.WordEncoder(f.read())
    asked = []

    def ids(words):
        asked.extend(words)
        return encoder.ids(words)

    texts = ["house cat house, cat! (cat) house.*** cat", "HOUSE, Cat.\ttree; tree", "\u00e9t\u00e9, \u00df. \u0130. \u01c5. e\u0301. a\u0338. \u017f.",
             "it's don't. o'er, x's. 12. a1, 'tis x_y x_ a<b b< <|endoftext|>. A<|endoftext|>, <|STARTOFTEXT|>", "", "\u0416\u0435, \u732b\u3002 \u732b. \xa0x.\x0by,\u2003z!",
             "\u00d7. \u00aa. \u2460. \u00e0\u0327. i\u0307."]
    coded = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, coded)])
    memory = WordIds(ids, parts=encoder.parts)
    for _ in range(2):
        got, at = memory.encode(encoder.words(b"".join(coded), offs))
        assert [got[a:b].tolist() for a, b in zip(at, at[1:])] == library(WORD, texts)
    assert len(asked) == len(set(asked)) and not {"house,", "cat!", "house.***", "cat.", "tree;"} & set(asked)
    assert {"house", "cat", "tree", ",", ".***"} <= set(asked)
    with open(BYTE, encoding="utf-8") as f:  # a model that cuts words otherwise
        assert records.WordEncoder(f.read()).parts(["house,"]) == {}


def test_word_memory_after_a_failure():
    from basketflow.llm.wordids import WordIds
    fail = [True]

    def encode(words):
        if fail[0]:
            raise ValueError
        return np.array([len(w) for w in words for _ in w], np.uint32), np.array([len(w) for w in words])

    memory = WordIds(encode, limit=3)
    with pytest.raises(ValueError):
        memory.encode([["ab", "c"]])
    fail[0] = False
    for _ in range(3):  # and over the limit
        ids, at = memory.encode([["ab", "c", "ab"], [], ["dd", "eee", "c", "ffff"]])
        assert ids.tolist() == [2, 2, 1, 2, 2, 2, 2, 3, 3, 3, 1, 4, 4, 4, 4] and at.tolist() == [0, 5, 5, 15]
