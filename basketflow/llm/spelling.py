"""Grouping of spelling variants by reduced-alphabet generation.

Two words are near if one inserted, deleted or replaced letter turns one into
the other.  Letters are hashed to a few symbols; near words have reduced words
that are equal or one edit apart.  So the full one-edit neighbourhood of every
reduced word, over the few symbols, is generated and met with the reduced
vocabulary; what meets is verified on the original strings.

An edit is seen from both of its words, so each is generated at one of them: a
deletion at the longer word (its other end is the insertion), a replacement at
the word with the smaller symbol, and the reduced word itself for letters of
one symbol.  Neighbours are hashes of reduced words, worked out for a whole
batch from prefix sums; a filter of bounded size drops those that no reduced
word of the vocabulary has, before anything is shuffled.  A full filter drops
less and changes no result.  The number of symbols follows the vocabulary, so
that few words share a reduced word at any size.

A word's ``form`` is its near word with the largest count, if that is at least
``ratio`` times its own; ``root`` follows the forms to the last.  Counts rise by
``ratio`` at every step, so chains are short; they are followed by doubling.

Defined cases: a null text has no words; a null id reads as the empty string in
the simulated slips of the report; rows that repeat an id count as often as they
stand there; words in capitals beyond A-Z keep them; no words give no rows.
Columns beside id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import mix64, ship_package, stored, work_folder
from basketflow.llm.near_dup import FILTER_BITS, passes

LETTERS = "[a-zÀ-ÿ]"
SHORTEST = 7  # code points of a word
LEAST = 2  # occurrences of a word
RATIO = 10  # how much more frequent a form is
FEWEST, MOST = 6, 24  # symbols of the reduced alphabet
CELLS = 1 << 15  # letters of the words (filled up to the longest) that are worked on at once

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def lowered(text: str) -> F.Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(text), upper, upper.lower())


def runs(docs: DataFrame, text_col: str = "text", shortest: int = SHORTEST, *keep: F.Column) -> DataFrame:
    """``run``: every maximal run of at least ``shortest`` letters, A-Z folded."""
    found = F.regexp_extract_all(lowered(text_col), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    return docs.select(*keep, F.explode(found).alias("run"))


def slipped(run: str, key: F.Column) -> F.Column:
    """``run`` with a letter dropped, if 31 divides the crc32 of ``key:run``."""
    h = F.crc32(F.concat(key, F.lit(":"), F.col(run)).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    dropped = F.concat(F.substring(F.col(run), F.lit(1), at), F.substring(F.col(run), at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(31)) == 0, dropped).otherwise(F.col(run))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of the words of ``words`` that are long and frequent enough."""
    return (words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= least))


def symbols_for(n_words: int, shortest: int) -> int:
    """Symbols for which the shortest reduced words are several times as many
    as the words."""
    k = FEWEST
    while k < MOST and k ** shortest < 4 * n_words:
        k += 1
    return k


def reduce_letters(code_points: np.ndarray, k: int) -> np.ndarray:
    """Symbols 1..k of letters."""
    return (code_points.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(k) + np.uint64(1)


def alike(words: pa.Array):
    """Row numbers of words of about one length, a bounded number of letters
    at a time (or one word)."""
    n = pc.utf8_length(words).to_numpy()
    order = np.argsort(n, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * n[order[end]] <= CELLS:
            end += 1
        yield order[at:end]
        at = end


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.append(np.uint64(1), np.full(n, _BASE, np.uint64)))[:n]


def reduced(words: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (words x longest, 0 beyond a word's end), prefix sums of their
    polynomial (words x longest + 1) and the words' lengths."""
    texts = words.to_pylist()
    n = np.array([len(t) for t in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    longest = int(n.max(initial=0))
    inside = np.arange(longest) < n[:, None]
    symbols = np.zeros((len(texts), longest), np.uint64)
    symbols[inside] = reduce_letters(letters, k)
    sums = np.zeros((len(texts), longest + 1), np.uint64)
    np.cumsum(symbols * powers(longest), axis=1, out=sums[:, 1:])
    return symbols, sums, n


def neighbourhood(symbols: np.ndarray, sums: np.ndarray, n: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the generated half of every word's reduced one-edit
    neighbourhood; the other half is generated at the other words."""
    whole = sums[:, -1]
    rows, codes = [np.arange(len(n))], [whole]
    power = powers(symbols.shape[1])
    for i in range(symbols.shape[1]):
        here = np.flatnonzero(i < n)
        s = symbols[here, i]
        # Dropping either of two equal neighbours gives the same word.
        last = i + 1 >= n[here]
        after = np.where(last, 0, symbols[here, min(i + 1, symbols.shape[1] - 1)])
        drop = here[after != s]
        rows.append(drop)
        codes.append(sums[drop, i] + (whole[drop] - sums[drop, i + 1]) * _INVERSE)
        for other in range(2, k + 1):
            put = here[s < other]
            rows.append(put)
            codes.append(whole[put] + (np.uint64(other) - symbols[put, i]) * power[i])
    return np.concatenate(rows), mix64(np.concatenate(codes)).view(np.int64)


def codes_of(words: DataFrame, k: int) -> DataFrame:
    """``words`` (word, n) with ``id``, the hash of the reduced word."""
    def run(batches):
        for batch in batches:
            codes = np.zeros(batch.num_rows, np.int64)
            for rows in alike(batch.column(0)):
                _, sums, _ = reduced(batch.column(0).take(pa.array(rows)), k)
                codes[rows] = mix64(sums[:, -1]).view(np.int64)
            yield batch.append_column("id", pa.array(codes))
    return words.select("word", "n").mapInArrow(run, "word string, n long, id long")


def neighbours_of(words: DataFrame, k: int, known) -> DataFrame:
    """(id, other, other_n): the generated neighbours of every word that pass
    the filter ``known`` (a broadcast of ``code_filter``)."""
    def run(batches):
        for batch in batches:
            for rows in alike(batch.column(0)):
                part = batch.take(pa.array(rows))
                row, code = neighbourhood(*reduced(part.column(0), k), k)
                keep = passes(known.value, pa.array(code))
                row = pa.array(row[keep])
                yield pa.RecordBatch.from_arrays([pa.array(code[keep]), part.column(0).take(row), part.column(1).take(row)],
                                                 names=["id", "other", "other_n"])
    return words.select("word", "n").mapInArrow(run, "id long, other string, other_n long")


def code_filter(codes: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Bit filter (64-bit words) of the column ``id``, which holds hashes: two
    bits each among 16 per row, or among ``most_bits`` if that is less."""
    n = codes.count()
    bits = min(most_bits, 1 << max(12, (16 * n - 1).bit_length() if n else 0))
    at = F.array(F.col("id").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("id", 32).bitwiseAND(F.lit(bits - 1)))
    found = (codes.select(F.explode(at).alias("p"))
             .select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits"))).toPandas()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def near_pairs(words: DataFrame, folder: str, shortest: int = SHORTEST) -> DataFrame:
    """(word, n, other, other_n) of all near words, both ways."""
    spark = words.sparkSession
    ship_package(spark)
    k = symbols_for(words.count(), shortest)
    coded = stored(codes_of(words, k), f"{folder}/codes")
    known = spark.sparkContext.broadcast(code_filter(coded))
    met = (coded.join(neighbours_of(words, k, known), "id")
           .where((F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
           .select("word", "n", "other", "other_n"))
    # Words of one reduced word meet twice.
    same = F.length("word") == F.length("other")
    once = stored(met.select(F.when(same, F.least("word", "other")).otherwise(F.col("word")).alias("word"),
                             F.when(same & (F.col("other") < F.col("word")), F.col("other_n")).otherwise(F.col("n")).alias("n"),
                             F.when(same, F.greatest("word", "other")).otherwise(F.col("other")).alias("other"),
                             F.when(same & (F.col("other") < F.col("word")), F.col("n")).otherwise(F.col("other_n"))
                             .alias("other_n")).distinct(), f"{folder}/near")
    return once.union(once.select("other", "other_n", "word", "n"))


def variants(words: DataFrame, ratio: int = RATIO, shortest: int = SHORTEST, folder: str | None = None) -> DataFrame:
    """``words`` (word, n) with ``n_near``, ``form`` and ``form_n``."""
    folder = folder or work_folder(words.sparkSession, "spelling")
    near = near_pairs(words, folder, shortest).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    best_n = -F.col("best.less")
    enough = best_n >= F.col("n") * F.lit(ratio)
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, best_n).alias("form_n"))


def with_roots(found: DataFrame, folder: str) -> DataFrame:
    """``found`` with ``root``: where the forms lead to.  Every round doubles
    the length of the chains that are followed."""
    links = stored(found.where("form is not null").select("word", F.col("form").alias("root")), f"{folder}/roots-0")
    k = 0
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = links.join(on, "root", "left")
        if step.where("beyond is not null").isEmpty():
            break
        k += 1
        links = stored(step.select("word", F.coalesce("beyond", "root").alias("root")), f"{folder}/roots-{k}")
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(words: DataFrame, ratio: int = RATIO, shortest: int = SHORTEST, folder: str | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n)."""
    folder = folder or work_folder(words.sparkSession, "spelling")
    return with_roots(stored(variants(words, ratio, shortest, folder), f"{folder}/variants"), folder)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``op11`` contract, over the words of ``docs`` with simulated slips."""
    folder = work_folder(docs.sparkSession, "spelling")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    words = runs(docs, text_col, SHORTEST, key.alias("key")).select(slipped("run", F.col("key")).alias("word"))
    known = stored(vocabulary(words), f"{folder}/words")
    return group_variants(known, folder=folder).select("word", "form", "root", "n", "n_near", "form_n")
