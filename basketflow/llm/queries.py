"""The ``opN_<name>`` queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketflow.llm import (ann, bpe, cotrain, decontam, langid, license_scan, manifest, mixing, near_dup,
                            pseudo_lm, records, secret_forest, spelling)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_multiprobe_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.report(_table(spark, sf_dir, "embeddings"))


def op2_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op3_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.report(_table(spark, sf_dir, "documents"))


def op4_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_license_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(_table(spark, sf_dir, "documents"))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_lm.report(_table(spark, sf_dir, "documents"))


def op7_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.report(_table(spark, sf_dir, "documents"))


def op8_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(_table(spark, sf_dir, "documents"))


def op12_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op13_postorder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(_table(spark, sf_dir, "documents"))


QUERIES = (op1_multiprobe_hashing, op2_output_codes, op3_secret_forest, op4_fm_decontamination, op5_license_tfidf,
           op6_pseudo_likelihood, op7_tensored_minhash, op8_record_files, op9_cotraining, op10_bpe_transducer,
           op11_reduced_alphabet, op12_pivotal_mixing, op13_postorder_manifest)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


# Words of op4: A-Z lower-cased, then runs of digits, a-z and non-ASCII.
_OP4 = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
listed AS (
  SELECT kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered),
items AS (SELECT id AS item_id, w, least(13, len(w)) AS k FROM listed WHERE kind = 'b' AND len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT id AS doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM listed, sizes WHERE kind = 'd' AND len(w) >= k)),
hits AS (SELECT p.doc_id, p.i, p.k, x.item_id FROM places p JOIN windows x ON p.phrase = x.phrase AND p.k = x.k),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM listed d LEFT JOIN hit_words h ON h.doc_id = d.id LEFT JOIN hit_items i ON i.doc_id = d.id
WHERE d.kind = 'd'
"""


# Words of op7: A-Z lower-cased, split at ASCII white space.
_OP7 = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, coalesce(list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> ''), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM listed WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes k ON k.doc_id = p.b
  WHERE 100 * p.both >= 85 * (m.n + k.n - p.both)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM listed
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM listed d LEFT JOIN sizes z ON z.doc_id = d.doc_id JOIN least_of c ON c.doc_id = d.doc_id
"""


def _op5() -> str:
    rows = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in license_scan.TEMPLATES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = f"list_filter(string_split_regex(translate({{}}, '{upper}', '{lower}'), '[^a-z0-9]+'), lambda w: w <> '')"
    return f"""
WITH templates(license, t) AS (VALUES {rows}),
template_terms AS (SELECT license, term, count(*) AS tf
                   FROM (SELECT license, unnest({terms.format('t')}) AS term FROM templates) GROUP BY ALL),
vocabulary AS (SELECT DISTINCT term FROM template_terms),
lines AS (SELECT doc_id, source, generate_subscripts(l, 1) - 1 AS unit, unnest(l) AS line
          FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents)),
words AS (SELECT doc_id, source, unit, unnest({terms.format('line')}) AS term FROM lines),
line_terms AS (SELECT doc_id, unit, term, count(*) AS tf FROM words GROUP BY ALL),
n_lines AS (SELECT count(DISTINCT (doc_id, unit)) AS n FROM words),
idf AS (SELECT v.term, ln((1.0 + n) / (1.0 + count(t.term))) + 1 AS idf
        FROM vocabulary v CROSS JOIN n_lines LEFT JOIN line_terms t ON t.term = v.term GROUP BY v.term, n),
weights AS (SELECT license, term, tf * idf / sqrt(sum((tf * idf) ^ 2) OVER (PARTITION BY license)) AS w, idf
            FROM template_terms JOIN idf USING (term)),
units AS (SELECT * FROM line_terms UNION ALL
          SELECT doc_id, -1, term, sum(tf) FROM line_terms GROUP BY doc_id, term),
norms AS (SELECT doc_id, unit, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (ln(1.0 + n) + 1) ^ 2
                                             ELSE (tf * idf) ^ 2 END)) AS norm
          FROM units CROSS JOIN n_lines LEFT JOIN idf USING (term) GROUP BY doc_id, unit),
found AS (SELECT doc_id, unit, license, sum(tf * idf * w) / norm AS s
          FROM units JOIN weights USING (term) JOIN norms USING (doc_id, unit)
          GROUP BY doc_id, unit, license, norm HAVING sum(tf * idf * w) / norm >= {license_scan.THRESHOLD}),
own AS (SELECT doc_id, round(s, 6) AS s, license FROM found WHERE unit >= 0
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 6) DESC, license) = 1),
dirs AS (SELECT d.source AS dir, round(s, 6) AS s, license FROM found f JOIN documents d USING (doc_id) WHERE unit = -1
         QUALIFY row_number() OVER (PARTITION BY d.source ORDER BY round(s, 6) DESC, license) = 1)
SELECT d.doc_id, coalesce(o.license, i.license) AS license, coalesce(o.s, i.s) AS similarity,
       CASE WHEN o.license IS NOT NULL THEN 'own' WHEN i.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN o.license IS NULL THEN i.dir END AS licence_dir
FROM documents d LEFT JOIN own o ON o.doc_id = d.doc_id LEFT JOIN dirs i ON i.dir = d.source
"""


def _crc32(code_points: str) -> str:
    """SQL of the unsigned crc32 of a list of bytes; ``crc_table`` (a one-row
    table of the 256 remainders ``t``) must be in scope."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {code_points}), "
            "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _op11() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # Letters beyond ASCII take two bytes of UTF-8, 195 and the code point less 64.
    utf8 = ("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda d: "
            "CASE WHEN unicode(d) < 128 THEN [unicode(d)::BIGINT] ELSE [195, unicode(d) - 64] END))")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{spelling.LETTERS}+')) AS run
         FROM documents),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {spelling.SHORTEST} GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32(utf8)} AS h FROM counted, crc_table),
slipped AS (SELECT k, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                           ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM slipped WHERE length(word) >= {spelling.SHORTEST}
          GROUP BY word HAVING sum(k) >= {spelling.LEAST}),
cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS cut
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word AS a, b.word AS b, b.n FROM cuts a JOIN words b ON b.word = a.cut
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.cut
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word),
best AS (SELECT a, count(*) AS n_near, max(n) AS top_n, min(b) FILTER (n = top) AS top
         FROM (SELECT *, max(n) OVER (PARTITION BY a) AS top FROM near) GROUP BY a),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                 CASE WHEN top_n >= {spelling.RATIO} * n THEN best.top END AS form,
                 CASE WHEN top_n >= {spelling.RATIO} * n THEN top_n END AS form_n
          FROM words w LEFT JOIN best ON best.a = w.word),
chains(word, leads_to) AS (
  SELECT word, word FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.leads_to WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.leads_to AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c ON c.word = f.word JOIN forms e ON e.word = c.leads_to WHERE e.form IS NULL
"""


def _op13() -> str:
    def leaf(n_chars: str) -> str:
        parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
        return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""{name}(grp, level, i, h) AS (
  {leaves}
  UNION ALL
  SELECT grp, level + 1, i // 2, sha256(h || coalesce(after, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY grp ORDER BY i) AS after, count(*) OVER (PARTITION BY grp) AS n FROM {name})
  WHERE n > 1 AND i % 2 = 0)"""

    digits = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, {leaf('n_chars')} AS leaf,
         CASE WHEN {_crc32(digits)} % 7 = 0 THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS found
  FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
{tree('nodes', 'SELECT grp, 0, i, leaf FROM placed')},
highest AS (SELECT grp, h, level AS top FROM nodes
            QUALIFY row_number() OVER (PARTITION BY grp ORDER BY level DESC) = 1),
subroots AS (SELECT *, row_number() OVER (ORDER BY grp) - 1 AS i FROM highest),
{tree('tops', "SELECT 'all', 0, i, h FROM subroots")},
top_root AS (SELECT h, level FROM tops ORDER BY level DESC LIMIT 1),
steps AS (
  SELECT p.grp, p.i, s.level AS k, (p.i >> s.level) % 2 = 1 AS odd, n.h
  FROM placed p JOIN (SELECT grp, unnest(range(top)) AS level FROM subroots) s ON s.grp = p.grp
  LEFT JOIN nodes n ON n.grp = p.grp AND n.level = s.level AND n.i = xor(p.i >> s.level, 1)
  UNION ALL
  SELECT p.grp, p.i, r.top + s.level, (r.i >> s.level) % 2 = 1, n.h
  FROM placed p JOIN subroots r ON r.grp = p.grp, (SELECT unnest(range(level)) AS level FROM top_root) s
  LEFT JOIN tops n ON n.level = s.level AND n.i = xor(r.i >> s.level, 1)),
folds(grp, i, k, h) AS (
  SELECT grp, i, 0, found FROM placed
  UNION ALL
  SELECT f.grp, f.i, f.k + 1, CASE WHEN s.h IS NULL THEN sha256(f.h) WHEN s.odd THEN sha256(s.h || f.h)
                                   ELSE sha256(f.h || s.h) END
  FROM folds f JOIN steps s ON s.grp = f.grp AND s.i = f.i AND s.k = f.k),
proofs AS (SELECT grp, i, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof FROM steps GROUP BY grp, i),
ends AS (SELECT grp, i, h FROM folds QUALIFY row_number() OVER (PARTITION BY grp, i ORDER BY k DESC) = 1)
SELECT p.doc_id, p.leaf, r.h AS subroot, t.h AS root, coalesce(o.proof, sha256('')) AS proof_sha256,
       e.h AS folded_root, e.h = t.h AS verified
FROM placed p JOIN subroots r ON r.grp = p.grp JOIN ends e ON e.grp = p.grp AND e.i = p.i
LEFT JOIN proofs o ON o.grp = p.grp AND o.i = p.i, top_root t
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_fm_decontamination": _OP4, "op5_license_tfidf": _op5(), "op7_tensored_minhash": _OP7,
            "op11_reduced_alphabet": _op11(), "op13_postorder_manifest": _op13()}
