"""One query per operator of this folder, over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from meterline.llm import (
    bpe,
    classifier,
    codes,
    credentials,
    divergence,
    embeddings,
    jaccard,
    lines,
    mixing,
    quality,
    repeats,
    token_files,
    toxicity,
)
from meterline.llm.common import table
from meterline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), WORD_BPE))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10))


SQL["op2_line_dedup"] = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(generate_series(1, len(parts))) AS place, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS MATERIALIZED (
  SELECT doc_id, place, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS MATERIALIZED (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY doc_id
"""


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digests(credentials.scan(table(spark, sf_dir, "documents"), WORD_BPE))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digests(mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))


SQL["op7_mix_sources"] = """
WITH RECURSIVE tape AS MATERIALIZED (
  SELECT doc_id, source, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size AS begun
  FROM (
    SELECT doc_id, source, length(coalesce(text, '')) + 1 AS size,
      CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '-' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS place
    FROM documents
  )
), weights AS MATERIALIZED (
  SELECT source, letters, CAST(floor(sqrt(CAST(letters AS DOUBLE)) * 1048576) AS HUGEINT) AS weight
  FROM (SELECT source, sum(length(coalesce(text, '')) + 1) AS letters FROM documents GROUP BY source)
), shares AS MATERIALIZED (
  SELECT source, letters, row_number() OVER (ORDER BY source) AS i, CAST(1048576 * weight // sum(weight) OVER () AS BIGINT) AS p FROM weights
), setup AS MATERIALIZED (
  SELECT list(p ORDER BY i) AS p, CAST(1048576 AS BIGINT) AS n,
    CAST(max(((letters // 100000 + 1) * 1048576 + p - 1) // p) AS BIGINT) AS ends FROM shares
), slots AS (
  SELECT CAST(-1 AS BIGINT) AS slot, list_transform(p, lambda x: CAST(0 AS BIGINT)) AS k, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS turn, p, n, ends
  FROM setup
  UNION ALL
  SELECT slot, list_transform(k, lambda x, j: CASE WHEN j = best THEN x + 1 ELSE x END), best, k[best], p, n, ends
  FROM (
    SELECT slot + 1 AS slot, k, p, n, ends, coalesce(list_min(list_transform(list_filter(generate_series(1, len(p)),
      lambda j: k[j] * n // p[j] <= slot + 1), lambda j: ((k[j] + 1) * n + p[j] - 1) // p[j] * 100000 + j)) % 100000, 0) AS best
    FROM slots WHERE slot + 1 < ends
  )
)
SELECT doc_id, source, block AS mix_block, CAST(begun AS BIGINT) AS mix_at, block * s.n // h.p AS mix_release,
  ((block + 1) * s.n + h.p - 1) // h.p AS mix_deadline, block // h.p * s.n + s.slot AS mix_slot
FROM (SELECT *, CAST(begun AS BIGINT) // 100000 AS block FROM tape) t
JOIN shares h USING (source)
JOIN slots s ON s.i = h.i AND s.slot >= 0 AND s.turn = t.block % h.p
"""


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), BYTE_BPE, path)
    return token_files.digests(token_files.read(spark, path))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.drop_repeats(table(spark, sf_dir, "documents")))


SQL["op3_substring_dedup"] = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), placed AS MATERIALIZED (
  SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS place, len(words) AS n FROM texts
), windows AS MATERIALIZED (
  SELECT doc_id, place, sha256(array_to_string(words[place:place + 49], ' ')) AS name
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS place FROM texts WHERE len(words) >= 50)
), firsts AS MATERIALIZED (
  SELECT name, min(doc_id) AS first_id FROM windows GROUP BY name
), gone AS MATERIALIZED (
  SELECT doc_id, place FROM windows JOIN firsts USING (name) WHERE doc_id > first_id
), judged AS MATERIALIZED (
  SELECT p.doc_id, p.place, p.word, max(g.place IS NOT NULL) OVER (
    PARTITION BY p.doc_id ORDER BY p.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS removed
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place
)
SELECT t.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT removed) AS kept
  FROM judged GROUP BY doc_id
) j ON t.doc_id = j.doc_id
"""


@query
def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


SQL["op5_ngram_jaccard"] = r"""
WITH RECURSIVE texts AS MATERIALIZED (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[place:place + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS place FROM texts WHERE len(words) > 0)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT t.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM texts t LEFT JOIN sizes USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = t.doc_id
"""


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op4_quality_rules"] = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), placed AS MATERIALIZED (
  SELECT doc_id, unnest(generate_series(1, len(words))) AS place, words FROM texts
), runs AS MATERIALIZED (
  SELECT doc_id, place, CASE WHEN place + 2 <= len(words) THEN array_to_string(words[place:place + 2], ' ') END AS run FROM placed
), twice AS MATERIALIZED (
  SELECT doc_id, place, run IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, run) > 1 AS again FROM runs
), repeats AS MATERIALIZED (
  SELECT doc_id, count(*) FILTER (WHERE covered) AS n_repeat_words FROM (
    SELECT doc_id, bool_or(again) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered FROM twice
  ) GROUP BY doc_id
), lines AS MATERIALIZED (
  SELECT doc_id, host, line, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM texts)
), common AS MATERIALIZED (
  SELECT host, key FROM lines JOIN (SELECT host, count(*) AS docs FROM texts GROUP BY host) USING (host)
  WHERE n > 0 GROUP BY host, key, docs HAVING count(DISTINCT doc_id) >= 10 AND count(DISTINCT doc_id) * 100 >= docs * 2
), line_counts AS MATERIALIZED (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (WHERE c.key IS NOT NULL), 0) AS n_boilerplate
  FROM lines l LEFT JOIN common c ON c.host = l.host AND c.key = l.key WHERE n > 0 GROUP BY doc_id
), judged AS MATERIALIZED (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_boilerplate, 0) AS BIGINT) AS n_boilerplate
  FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN line_counts USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR (n_words - n_boilerplate) * 100 < n_words * 30) AS kept
FROM judged
"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


SQL["op11_source_divergence"] = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), occurrences AS MATERIALIZED (
  SELECT doc_id, lang, source, unnest(terms) AS term FROM texts
), kept AS MATERIALIZED (
  SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10
), groups AS MATERIALIZED (
  SELECT DISTINCT lang, source FROM texts
), counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM occurrences JOIN kept USING (lang, term) GROUP BY lang, source, term
), filled AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), shares AS MATERIALIZED (
  SELECT lang, source, term, n,
    1 + (1000000000 * (n::HUGEINT + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM filled
), lang_counts AS MATERIALIZED (
  SELECT lang, term, sum(n) AS n FROM filled GROUP BY lang, term
), lang_shares AS MATERIALIZED (
  SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM lang_counts
), pairs AS MATERIALIZED (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
  FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM ranked
) WHERE part = 'pair' OR rank <= 10
"""


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digests(*codes.compress(table(spark, sf_dir, "embeddings")))


def _vector_codes_sql(rounds: int = 4) -> str:
    """Each round of assigning and averaging spelt out; sums of whole numbers are exact in doubles here."""

    def assigned(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT vec_id, part, point, arg_min(entry, (error, entry)) AS entry, min(error) AS error
  FROM (
    SELECT vec_id, p.part, point, entry, list_inner_product(point, point) - 2 * list_inner_product(point, center) + list_inner_product(center, center) AS error
    FROM points p JOIN {book} b ON b.part = p.part
  ) GROUP BY vec_id, part, point
)"""

    ctes = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        """points AS MATERIALIZED (
  SELECT vec_id, part, vector[part * (len(vector) // 4) + 1 : (part + 1) * (len(vector) // 4)] AS point
  FROM kept, range(4) parts(part)
)""",
        """book0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, point AS center
  FROM points WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)""",
    ]
    for at in range(rounds):
        ctes.append(assigned(f"near{at}", f"book{at}"))
        ctes.append(f"""book{at + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(c.center, b.center) AS center FROM book{at} b LEFT JOIN (
    SELECT part, entry, list(average ORDER BY place) AS center FROM (
      SELECT part, entry, place, floor(sum(x) / count(*)) AS average
      FROM (SELECT part, entry, unnest(point) AS x, generate_subscripts(point, 1) AS place FROM near{at})
      GROUP BY part, entry, place
    ) GROUP BY part, entry
  ) c ON c.part = b.part AND c.entry = b.entry
)""")
    ctes.append(assigned("coded", f"book{rounds}"))
    ctes.append(f"""digest AS MATERIALIZED (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(center) AS x, generate_subscripts(center, 1) AS place FROM book{rounds})
)""")
    ctes.append("""vectors AS MATERIALIZED (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM coded GROUP BY vec_id
)""")
    return (
        "WITH "
        + ", ".join(ctes)
        + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM vectors JOIN kept USING (vec_id), digest
"""
    )


SQL["op12_vector_codes"] = _vector_codes_sql()


@query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
