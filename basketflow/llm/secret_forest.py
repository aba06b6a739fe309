"""Secret scan with a random forest that removes false positives.

Candidates are long runs of key-like characters that hold a digit, found in
whole texts.  A random forest (Spark ML) judges each by its length, character
transitions, dictionary coverage, path and neighbouring words.  It is trained
from labelled findings; where none are given, ``label_findings`` labels those
that a plain rule settles, and leaves the rest to the forest.

All steps are DataFrame expressions.  Findings are stored once in the shared
folder; texts are scanned once for them and once for the dictionary.  The
forest's sample is bounded by ``TRAIN_ROWS`` findings.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import stored, work_folder

TRAIN_ROWS = 20_000  # bound of the labelled findings that the forest reads
DICTIONARY_WORDS = 50_000
THRESHOLD = 0.5
TREES, DEPTH, SEED = 20, 6, 17
MASK = "[SECRET]"

_CHARS = r"A-Za-z0-9_+/.\-"
CANDIDATE = rf"(?<![{_CHARS}])(?=[A-Za-z_+/.\-]*[0-9])[{_CHARS}]{{16,}}={{0,2}}"
KEYWORD = r"(?i)(token|secret|passw|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
ASSIGNED = KEYWORD + r"[A-Za-z_]*[\"']?\s*[:=]+\s*[\"']?$"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|xxxx|changeme|your[_-])"
TEST_PATH = r"(?i)(test|example|sample|doc|mock|fixture)"

FEATURES = ["length", "changes", "digits", "upper", "lower", "symbols", "distinct", "hex", "vowel_pairs", "covered",
            "path_test", "path_depth", "keyword", "assigned", "quoted", "at_sign", "placeholder"]


def dictionary(docs: DataFrame, text_col: str = "text", n_words: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words (3 letters or more, lower case) of all texts."""
    word = F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+"))
    return (docs.select(word.alias("word")).where(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "word").limit(n_words).select("word"))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row per candidate: id, hash of the text, path, candidate, start, end
    (characters of the text, end exclusive), and the text right before and after
    it."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    text = F.col("text")
    found = (docs.select(F.col(id_col).alias("id"), F.coalesce(path, F.lit("")).alias("path"),
                         F.col(text_col).alias("text"))
             .where(text.rlike(CANDIDATE))
             .select("id", F.xxhash64("text").alias("text_hash"), "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
                     F.split("text", CANDIDATE, -1).alias("between")))
    # Running starts: the pieces before a candidate and the candidates before it.
    step = F.aggregate(
        F.arrays_zip("found", F.slice("between", 1, F.size("found")).alias("before")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, x: F.struct((a["at"] + F.length(x["before"]) + F.length(x["found"])).alias("at"),
                              F.concat(a["starts"], F.array(a["at"] + F.length(x["before"]))).alias("starts")))
    rows = found.withColumn("starts", step["starts"]).select(
        "id", "text_hash", "path", "between", F.posexplode(F.arrays_zip("found", "starts")).alias("k", "x"))
    return rows.select("id", "text_hash", "path", F.col("x.found").alias("candidate"), F.col("x.starts").alias("start"),
                       (F.col("x.starts") + F.length("x.found")).alias("end"),
                       F.substring(F.get("between", F.col("k")), -48, 48).alias("before"),
                       F.substring(F.get("between", F.col("k") + 1), 1, 16).alias("after"))


def _share(kind: str) -> F.Column:
    return F.length(F.regexp_replace("candidate", f"[^{kind}]", "")) / F.length("candidate")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the ``FEATURES``.  Dictionary coverage is worked out
    once per distinct candidate."""
    part = F.explode(F.expr(r"regexp_extract_all(lower(candidate), '[a-z]{3,}', 0)"))
    covered = (found.select("candidate").distinct().select("candidate", part.alias("word"))
               .join(words, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("letters")))
    size = F.length("candidate")
    kinds = F.translate("candidate", "".join(map(chr, [*range(65, 91), *range(97, 123), *range(48, 58)])) + "_+/.-=",
                        "A" * 26 + "a" * 26 + "9" * 10 + "------")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return found.join(covered, "candidate", "left").select(
        *found.columns,
        size.cast("double").alias("length"),
        ((runs - 1) / (size - 1)).alias("changes"),
        _share("0-9").alias("digits"), _share("A-Z").alias("upper"), _share("a-z").alias("lower"),
        _share(r"_+/.=\-").alias("symbols"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.least(size, F.lit(64))).alias("distinct"),
        flag(F.col("candidate").rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        (F.regexp_count("candidate", F.lit("(?i)[aeiou][bcdfghjklmnpqrstvwxyz]")) / size).alias("vowel_pairs"),
        (F.coalesce("letters", F.lit(0)) / size).alias("covered"),
        flag(F.col("path").rlike(TEST_PATH)).alias("path_test"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        flag(F.col("before").rlike(KEYWORD)).alias("keyword"),
        flag(F.col("before").rlike(r"[:=]\s*[\"']?$")).alias("assigned"),
        flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("quoted"),
        flag(F.col("before").rlike("@$") | F.col("after").rlike("^@")).alias("at_sign"),
        flag(F.concat_ws(" ", "before", "candidate").rlike(PLACEHOLDER)).alias("placeholder"))


def label_findings(found: DataFrame) -> DataFrame:
    """``label`` of the findings that a rule settles: 1 for a value of at least
    20 characters assigned to a name like token or password, 0 for mail
    addresses and host names, plain numbers, placeholders and candidates made
    of dictionary words; null otherwise."""
    host = F.col("candidate").rlike(r"^[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[a-z]{2,6}\.?$")
    no = (F.col("at_sign") > 0) | host | F.col("candidate").rlike("^[0-9.+/_-]+$") | (F.col("covered") >= 0.6) \
        | (F.col("placeholder") > 0)
    yes = F.col("before").rlike(ASSIGNED) & (F.col("length") >= 20)
    return found.withColumn("label", F.when(no, 0.0).when(yes, 1.0))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """The forest, or None if the labels (null labels don't count) lack a
    class.  ``labelled``: ``FEATURES``, candidate, label."""
    sample = (labelled.where("label is not null").orderBy(F.xxhash64("candidate", "before"), "candidate", "before")
              .limit(rows))
    sample = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.select("label", *FEATURES))
    if sample.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxMemoryInMB=64).fit(sample)


def judge(found: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """Findings with ``probability`` and ``is_secret``.  Without a model the
    label decides (unlabelled: no secret)."""
    if model is None:
        p = F.coalesce("label", F.lit(0.0)) if "label" in found.columns else F.lit(0.0)
        return found.withColumn("probability", p).withColumn("is_secret", F.col("probability") >= threshold)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return (scored.withColumn("probability", vector_to_array("probability")[1])
            .withColumn("is_secret", F.col("probability") >= threshold).drop("features", "rawPrediction", "prediction"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         labelled: DataFrame | None = None, folder: str | None = None) -> DataFrame:
    """All candidates of all texts, judged: id, text_hash, path, candidate, start, end,
    before, after, features, label, probability, is_secret.

    Null and empty texts have no candidates; a null path counts as an empty
    one; rows that repeat an id are scanned each; other columns play no part.
    ``labelled``: findings of the same form with a ``label`` column."""
    folder = folder or work_folder(docs.sparkSession, "secrets")
    words = stored(dictionary(docs, text_col), f"{folder}/dictionary")
    raw = stored(candidates(docs, id_col, text_col, path_col), f"{folder}/candidates")
    found = stored(label_findings(with_features(raw, words)), f"{folder}/findings")
    return judge(found, train(labelled if labelled is not None else found))


def redact(docs: DataFrame, secrets: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret (rows of ``scan`` with ``is_secret``) of a
    text replaced by ``MASK``.  Only texts that hold a candidate are moved to
    meet their spans, by id (null or not) and hash of the text: rows that repeat
    an id may differ in text."""
    spans = (secrets.where("is_secret").groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
             .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__spans")))  # one text's spans
    has = F.coalesce(F.col(text_col).rlike(CANDIDATE), F.lit(False))
    text = F.col(text_col)
    cut = F.aggregate(
        "__spans", F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda a, s: F.struct(F.concat(a["kept"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(MASK))
                              .alias("kept"), s["end"].alias("at")))
    masked = F.when(F.col("__spans").isNull(), text).otherwise(
        F.concat(cut["kept"], F.substring(text, cut["at"] + 1, F.length(text))))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash"))
    touched = docs.where(has).join(spans, same, "left").withColumn(text_col, masked)
    return docs.where(~has).unionByName(touched.select(docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """One row per candidate (``op3``); the candidate only as its digest."""
    return scan(docs, path_col="source").select(
        F.col("id").alias("doc_id"), "start", "end", F.sha2("candidate", 256).alias("candidate_sha256"), "label",
        "probability", "is_secret")
