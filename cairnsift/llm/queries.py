"""The registered queries of the text operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnsift.llm import (decontaminate, html_text, language_model, license_scan, line_dedup, mixing, near_dup, quality, secret_scan, spelling,
                           substring_dedup, token_counts, whitening)
from cairnsift.llm.shared import shipped
from cairnsift.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return shipped(configure(spark)).read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


# DuckDB: the words of a text, and its white space as a class.
D_WORDS = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {D_WORDS.format(t='text')} AS w FROM documents
), lines AS (
  SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), wins AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5
), keyed AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS n FROM wins
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM keyed WHERE n > 1) GROUP BY doc_id
), rest AS (
  SELECT doc_id, list_filter(l, lambda x: regexp_matches(right(rtrim(x), 3), '[.!?…:;][\["'')\]”’»]{{0,2}}$')
    AND 10 * len(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) <= 3 * (len(x) - len(replace(x, ' ', '')) + 1)
    AND 10 * len(regexp_replace(x, '[^|»›·•→]', '', 'g')) <= 2 * (len(x) - len(replace(x, ' ', '')) + 1)
    AND NOT regexp_matches(lower(x), 'all rights reserved|licensed under|terms of service|privacy policy|cookie policy|enable javascript|lorem ipsum|click here|copyright|©')
  ) AS k FROM lines
), counted AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(array_to_string(d.w, ''))::BIGINT AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
    (len(array_to_string(d.w, '')) - len(regexp_replace(array_to_string(k, ' '), '[\x20\x09-\x0D]', '', 'g')))::BIGINT AS lost_chars
  FROM d JOIN (SELECT doc_id, l FROM lines) USING (doc_id) JOIN rest USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM counted
"""


@query("op2_quality_rules", OP2)
def quality_rules(spark: SparkSession, root: str) -> DataFrame:
    judged = quality.assess(table(spark, root, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         F.col("lost_chars").cast("long").alias("lost_chars"), "base_failed", "kept")


OP4 = """
WITH sizes AS (
  SELECT source AS s, sum(length(coalesce(text, '')))::BIGINT AS size FROM documents GROUP BY 1
), rated AS (
  SELECT s, CASE WHEN size > 0 THEN 1.0::DOUBLE / (SELECT count(*) FROM sizes WHERE size > 0)::DOUBLE * (SELECT sum(size) FROM sizes)::DOUBLE / size::DOUBLE ELSE 0.0::DOUBLE END AS rate FROM sizes
), parted AS (
  SELECT s, rate, greatest(1, ceil(rate / 16.0))::INT AS parts, rate / greatest(1, ceil(rate / 16.0)) AS each FROM rated
), dist AS (
  SELECT s, any_value(rate) AS rate, any_value(parts) AS parts, list(c ORDER BY k) AS cdf FROM (
    SELECT s, rate, parts, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM (
      SELECT s, rate, parts, k, CASE WHEN rate > 0 THEN exp(-each + k * ln(each) - lgamma(k + 1)) ELSE CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END END AS p
      FROM parted, range(0, 81) r(k))) GROUP BY s
), drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, x.rate,
    CASE WHEN x.rate > 0 THEN list_sum(list_transform(range(1, x.parts + 1),
      lambda j: len(list_filter(x.cdf, lambda c: c <= ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || j::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0)))) ELSE 0 END AS n
  FROM documents d JOIN dist x ON d.source IS NOT DISTINCT FROM x.s
)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copy::INT AS copy, md5('mix:place:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy::VARCHAR) AS place
FROM (SELECT *, unnest(range(0, n::BIGINT)) AS copy FROM drawn)
"""


@query("op4_mix_sources", OP4)
def mix_sources(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents")).withColumn("rate", F.round("rate", 9))


OP7 = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l, list_transform(string_split(text, chr(10)), lambda x: md5(x)) AS h FROM documents WHERE text IS NOT NULL
), ends AS (
  SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: i = len(l) OR
    ('0x' || substr(md5(coalesce(CASE WHEN i > 1 THEN h[i - 1] END, '') || h[i]), 1, 8))::BIGINT % 2 = 0) AS e FROM lines
), cut AS (
  SELECT doc_id, unnest(list_transform(range(1, len(e) + 1), lambda k: {'ord': k - 1, 'chunk': array_to_string(l[(CASE WHEN k > 1 THEN e[k - 1] ELSE 0 END) + 1 : e[k]], chr(10)),
    'multi': e[k] - (CASE WHEN k > 1 THEN e[k - 1] ELSE 0 END) > 1}), recursive := true) FROM ends
), judged AS (
  SELECT doc_id, ord, chunk, multi AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, ord) > 1 AS gone FROM cut
)
SELECT d.doc_id, coalesce(count(j.ord), 0)::INT AS n_chunks, (count(*) FILTER (WHERE gone))::INT AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(string_agg(chunk, chr(10) ORDER BY ord) FILTER (WHERE NOT gone), '') END AS text
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id, d.text
"""


@query("op7_line_dedup", OP7)
def line_chunks(spark: SparkSession, root: str) -> DataFrame:
    return line_dedup.remove(table(spark, root, "documents").select("doc_id", "text")).select("doc_id", "n_chunks", "n_removed", "text")


OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13
), old AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY array_to_string(w[i:i + 12], ' ')) AS first FROM wins) WHERE first < doc_id
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM old) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(ps, k)), lambda k: w[k]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""


@query("op1_substring_dedup", OP1)
def repeated_passages(spark: SparkSession, root: str) -> DataFrame:
    return substring_dedup.remove(table(spark, root, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_near_duplicates")
def near_duplicates(spark: SparkSession, root: str) -> DataFrame:
    return near_dup.groups(table(spark, root, "documents"), width=4)


@query("op9_token_counts")
def token_counts_query(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count(table(spark, root, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_benchmark_leaks")
def benchmark_leaks(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.find(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query("op5_secret_scan")
def secrets(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.scan(table(spark, root, "documents"))


@query("op6_main_text")
def main_text(spark: SparkSession, root: str) -> DataFrame:
    return html_text.main_text(table(spark, root, "pages"))


@query("op8_lm_score")
def lm_score(spark: SparkSession, root: str) -> DataFrame:
    return language_model.scored(table(spark, root, "documents"))


OP11 = """
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents
), counted AS (
  SELECT id, r, count(*) AS c FROM runs GROUP BY ALL
), crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY b) AS t FROM range(256) q(b)
), hashed AS (
  SELECT r, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || ':' || r, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch)::BIGINT - 64] END))),
    lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]))) AS h FROM counted, crc
), spoiled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, c FROM hashed
), vocab AS (
  SELECT word, sum(c)::BIGINT AS n FROM spoiled WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), spots AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab
), holes AS (
  SELECT word, n, substr(word, 1, i::INT - 1) || '*' || substr(word, i::INT + 1) AS p FROM spots
), cuts AS (
  SELECT DISTINCT word, n, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS p FROM spots
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.p = b.p AND a.word <> b.word
  UNION ALL SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON c.p = v.word
  UNION ALL SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON c.p = v.word
), ranked AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS k FROM near
), judged AS (
  SELECT v.word, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n, n, coalesce(n_near, 0)::BIGINT AS n_near
  FROM vocab v LEFT JOIN ranked r ON v.word = r.word AND k = 1
), led AS (
  SELECT word, word AS at, form AS next FROM judged
  UNION ALL SELECT l.word, j.word, j.form FROM led l JOIN judged j ON l.next = j.word
)
SELECT j.word, j.form, l.at AS root, j.n, j.n_near, j.form_n FROM judged j JOIN led l ON l.word = j.word AND l.next IS NULL
"""


@query("op11_spelling_variants", OP11)
def spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return spelling.variants(table(spark, root, "documents"), spoil=97)


def license_sql() -> str:
    """Each template as a regular expression over the words joined by blanks, tried where its first two words stand."""
    def pattern(parts: list[tuple]) -> str:
        out = ""
        for part in parts:
            if part[0] == "var":
                out += f"(?:{'[0-9]+' if part[3] else '[^ ]+'} ){{{part[1]},{part[2]}}}"
            else:
                out += {"word": f"{part[-1]} ", "begin": "(?:", "end": ")?"}[part[0]]
        return out

    rules = [(label, False, pattern(license_scan.regions(t))) for label, t in license_scan.TEMPLATES]
    rules += [(label, True, pattern(license_scan.regions(p))) for p, label in license_scan.PHRASES.items()]
    starts = sorted({" ".join(p.split(" ")[:2]) for _, _, p in rules})
    listed = ",\n    ".join(f"('{label}', {phrase}, '^({p})')" for label, phrase, p in rules)
    return f"""
WITH rules(label, phrase, pattern) AS (VALUES
    {listed}
), d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), starts AS (
  SELECT k, i - 1 AS start, array_to_string(w[i:i + 400], ' ') || ' ' AS rest
  FROM (SELECT k, w, unnest(list_filter(range(1, len(w)), lambda i: list_contains({starts}, w[i] || ' ' || w[i + 1]))) AS i FROM d)
), found AS (
  SELECT k, start, label, phrase, regexp_extract(rest, pattern, 1) AS m FROM starts, rules WHERE regexp_matches(rest, pattern)
), places AS (
  SELECT k, start, label, phrase, length(m) - length(replace(m, ' ', '')) AS n FROM found
), covers AS (
  SELECT k, count(DISTINCT p) AS covered FROM (SELECT k, unnest(range(start, start + n)) AS p FROM places) GROUP BY k
), summed AS (
  SELECT k, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word, max(start) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY k
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(covered, 0)::DOUBLE / greatest(len(w), 1) AS score
FROM d LEFT JOIN summed USING (k) LEFT JOIN covers USING (k)
"""


@query("op12_license_scan", license_sql())
def license_places(spark: SparkSession, root: str) -> DataFrame:
    return license_scan.scan(table(spark, root, "documents"))


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whitened(table(spark, root, "embeddings"))
