"""Registered queries of the corpus operators and the DuckDB SQL of those
that SQL can express.  Each query applies one operator to its whole table."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    cross_polytope,
    gam_pairs,
    language_mixture,
    license_notices,
    license_templates,
    line_windows,
    phrase_tries,
    simhash_gray,
    systematic_mix,
    template_decontam,
    token_cache,
    token_files,
    toxic_segments,
    vector_codes,
)
from quarry.llm.common import held_out
from quarry.sources.tables import table

TOKEN_LIMIT = 1024
#: Id that ends each document in the token files.
END_ID = 1


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row per document and item."""
    return template_decontam.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op2_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted notices of every document."""
    return license_templates.scan_licenses(
        table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; trained where crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 3, 1)
    return language_mixture.predict(
        docs, language_mixture.fit(docs, ~held), {"doc_id": F.col("doc_id"), "held_out": held})


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op5_gam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = gam_pairs.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    groups = simhash_gray.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash_gray.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op7_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document.  Starts from a fresh cache, so a run
    never profits from an earlier one."""
    counts = token_cache.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and significant toxic passages of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxic_segments.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxic_segments.score_texts(
        docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out("doc_id", 5, 0)})
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "n_passages", "first_word", "last_word")


def op9_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies and words the mix takes of every document."""
    return (systematic_mix.mix_counts(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of repeated three-line windows."""
    return line_windows.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("_lines").cast("long").alias("n_lines"),
        F.col("_removed").cast("long").alias("n_removed"), "text")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the digest of the codebooks."""
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256", "label")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the token files just
    written, as read back from them."""
    folder = token_files.new_folder(spark)
    token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  folder, END_ID)
    return token_files.read_token_files(spark, folder)


def op13_phrase_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases."""
    return phrase_tries.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_template_decontamination, op2_license_templates, op3_language_mixture, op4_cross_polytope,
        op5_gam_pairs, op6_simhash_gray, op7_token_cache, op8_toxic_segments, op9_systematic_mix,
        op10_line_windows, op11_vector_codes, op12_token_files, op13_phrase_tries)}


def _license_regex(markup: str) -> str:
    """A template as a regular expression over " word word ... " text."""
    def piece(m: re.Match) -> str:
        mark = m[0]
        if mark == "<<beginOptional>>":
            return "(?:"
        if mark == "<<endOptional>>":
            return ")?"
        if mark.startswith("<<var;max="):
            return f"(?:[^ ]+ ){{1,{mark[10:-2]}}}"
        if mark.startswith("<<var;match="):
            return "(?:" + "|".join(re.sub("[^a-z0-9]+", " ", f" {x.lower()} ").lstrip()
                                    for x in mark[12:-2].split("|")) + ")"
        return mark.lower() + " "
    return "".join(piece(m) for m in re.finditer("(?s)<<.*?>>|[A-Za-z0-9]+", markup))


def _license_sql() -> str:
    def cases(templates: list[tuple[str, str]]) -> str:
        by_label: dict[str, list[str]] = {}
        for label, markup in templates:
            by_label.setdefault(label, []).append(_license_regex(markup))
        return ", ".join(f"CASE WHEN regexp_matches(norm, ' (?:{'|'.join(rs)})') THEN '{label}' END"
                         for label, rs in sorted(by_label.items()))
    whole, stated = cases(list(license_notices.NOTICES)), cases(list(license_notices.STATEMENTS))
    starts, labels = [], []
    for phrase, label in license_templates.BASE.items():
        words = phrase.split()
        test = " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        starts.append(f"list_filter(range(len(w)), lambda i: {test})")
        labels.append(f"CASE WHEN contains(norm, ' {phrase} ') THEN '{label}' END")
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
normed AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS norm FROM words),
found AS (
  SELECT doc_id, w, flatten([{', '.join(starts)}]) AS places,
    list_sort(list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL)) AS base,
    list_sort(list_filter([{whole}], lambda x: x IS NOT NULL)) AS whole,
    list_sort(list_filter([{stated}], lambda x: x IS NOT NULL)) AS stated FROM normed),
united AS (SELECT *, list_sort(list_distinct(list_concat(whole, stated))) AS own FROM found)
SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
  list_max(places)::BIGINT AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, own))), ',') AS labels,
  array_to_string(own, ',') AS templates, array_to_string(whole, ',') AS notices,
  CASE WHEN len(whole) > 0 THEN 1.0::DOUBLE WHEN len(own) > 0 THEN 0.75::DOUBLE
       WHEN len(places) > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM united"""


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, cap / w AS need,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
    / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM sources
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    least(cap::DOUBLE, (max(CASE WHEN level <= need THEN level END) OVER ()) * w) AS target FROM levels),
ranked AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('7:' || coalesce('s' || s.source, 'n')), 1, 8))::UBIGINT / 4294967296.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY s.source ORDER BY floor(ln(s.size + 1.0::DOUBLE) * 32),
      md5(coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size) AS r
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (least(floor(r * rate + u) - floor((r - 1) * rate + u), 3) * size)::BIGINT AS taken
FROM ranked"""

_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l AS line, regexp_replace(l, '^[\x09\x0B-\x0D\x20]+|[\x09\x0B-\x0D\x20]+$', '', 'g') AS t
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)),
full_lines AS (
  SELECT doc_id, i, t, row_number() OVER w AS r, count(*) OVER (PARTITION BY doc_id) AS n
  FROM lines WHERE t <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT a.doc_id, a.i AS lo, z.i AS hi,
    least(a.n, 3) || chr(10) || a.t || coalesce(chr(10) || b.t, '') || coalesce(chr(10) || c.t, '') AS win
  FROM full_lines a
  JOIN full_lines z ON z.doc_id = a.doc_id AND z.r = a.r + least(a.n, 3) - 1
  LEFT JOIN full_lines b ON b.doc_id = a.doc_id AND b.r = a.r + 1
  LEFT JOIN full_lines c ON c.doc_id = a.doc_id AND c.r = a.r + 2),
later AS (
  SELECT doc_id, lo, hi FROM (
    SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, lo) AS k FROM windows) WHERE k > 1),
gone AS (
  SELECT DISTINCT l.doc_id, l.i FROM lines l JOIN later w
  ON l.doc_id = w.doc_id AND l.i BETWEEN w.lo AND w.hi)
SELECT d.doc_id, coalesce(x.n_lines, 0)::BIGINT AS n_lines, coalesce(x.n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
    string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id) x
ON d.doc_id = x.doc_id"""

def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    cut = f"v[(dim // {parts}) * p + least(p, dim % {parts}) + 1 : (dim // {parts}) * (p + 1) + least(p + 1, dim % {parts})]"
    sql = rf"""
WITH valid AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
rows_ AS MATERIALIZED (
  SELECT *, len(v) AS dim, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn,
    row_number() OVER (PARTITION BY len(v) ORDER BY vec_id NULLS LAST, v) AS r FROM valid),
parts AS MATERIALIZED (
  SELECT rn, r, dim, p, x, coalesce(list_dot_product(x, x), 0) AS xx
  FROM (SELECT rn, r, dim, p, {cut} AS x FROM rows_, range({parts}) t(p))),
b0 AS MATERIALIZED (SELECT dim, p, r - 1 AS e, x AS c, xx AS cc FROM parts WHERE r <= {entries})"""
    for i in range(rounds + 1):
        sql += rf""",
a{i} AS MATERIALIZED (
  SELECT rn, dim, p, min({{'d': xx - 2 * coalesce(list_dot_product(x, c), 0) + cc, 'e': e}}) AS m
  FROM parts JOIN b{i} USING (dim, p) GROUP BY rn, dim, p)"""
        if i < rounds:
            sql += rf""",
s{i} AS (
  SELECT dim, p, e, i, sum(y::HUGEINT) AS s, count(*) AS n FROM (
    SELECT a.dim, a.p, a.m.e AS e, unnest(range(len(x))) AS i, unnest(x) AS y
    FROM a{i} a JOIN parts USING (rn, p)) GROUP BY dim, p, e, i),
n{i} AS (
  SELECT dim, p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM s{i} GROUP BY dim, p, e),
b{i + 1} AS MATERIALIZED (
  SELECT *, coalesce(list_dot_product(c, c), 0) AS cc FROM (
    SELECT b.dim, b.p, b.e, coalesce(n.c, b.c) AS c FROM b{i} b LEFT JOIN n{i} n
    ON b.dim = n.dim AND b.p = n.p AND b.e = n.e))"""
    return sql + rf""",
digests AS (
  SELECT dim, sha256(coalesce(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY p, e, i), '')) AS codebooks_sha256
  FROM (SELECT dim, p, e, unnest(range(len(c))) AS i, unnest(c) AS y FROM b{rounds}) GROUP BY dim),
coded AS (
  SELECT rn, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
  FROM a{rounds} GROUP BY rn)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256, label
FROM rows_ JOIN coded USING (rn) JOIN digests USING (dim)"""


def _phrases_sql(min_count: int = 100, top: int = 2000) -> str:
    grams = "\nUNION ALL\n".join(
        f"SELECT lang, array_to_string(w[i:i+{m-1}], ' ') AS phrase, {m} AS m FROM "
        f"(SELECT lang, w, unnest(range(1, len(w) - {m} + 2)) AS i FROM pieces WHERE len(w) >= {m})" for m in range(1, 6))
    return rf"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
grams AS MATERIALIZED (
  SELECT lang, phrase, m, count(*)::HUGEINT AS f FROM ({grams}) GROUP BY lang, phrase, m HAVING count(*) >= {min_count}),
long_ AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2),
inner_ AS (
  SELECT lang, array_to_string(w[i:i+k-1], ' ') AS phrase, f FROM long_, range(1, 6) a(i), range(2, 5) b(k)
  WHERE k < m AND i + k - 1 <= m),
around AS (SELECT lang, phrase, max(f) AS longer FROM inner_ GROUP BY lang, phrase),
kept AS (
  SELECT g.* FROM long_ g LEFT JOIN around a ON g.lang = a.lang AND g.phrase = a.phrase
  WHERE a.longer IS NULL OR 100 * a.longer < 100 * g.f),
cuts AS (
  SELECT k.lang, k.phrase, k.f AS a, c, h.f AS l, t.f AS r, n, (1000 * k.f * n) // (h.f * t.f) AS score
  FROM kept k JOIN range(1, 5) x(c) ON c < k.m JOIN totals USING (lang)
  JOIN grams h ON h.lang = k.lang AND h.phrase = array_to_string(w[1:c], ' ')
  JOIN grams t ON t.lang = k.lang AND t.phrase = array_to_string(w[c+1:], ' ')),
best AS (
  SELECT lang, phrase, a, n, min({{'score': score, 'c': c, 'l': l, 'r': r}}) AS b FROM cuts GROUP BY lang, phrase, a, n),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, encode(phrase)) AS rank, phrase,
    a::BIGINT AS a, b.l::BIGINT AS l, b.r::BIGINT AS r, n::BIGINT AS n, b.score::BIGINT AS score FROM best)
SELECT * FROM ranked WHERE rank <= {top}"""


ORACLE_SQL: dict[str, str] = {
    "op2_license_templates": _license_sql().strip(),
    "op9_systematic_mix": _MIX_SQL.strip(),
    "op10_line_windows": _LINES_SQL.strip(),
    "op11_vector_codes": _codes_sql().strip(),
    "op13_phrase_tries": _phrases_sql().strip(),
}
