"""The operators' results in DuckDB SQL, written from their definitions rather than from the Spark code."""

from __future__ import annotations

from ebbline.llm.quality import QualityOptions
from ebbline.llm.sharding import MULTIPLIER
from ebbline.llm.text import UPPER
from ebbline.llm.urls import HOST_RULES, PATTERN_RULES

SPACE = r"[\x20\x09-\x0D]"
TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = f"'{UPPER}', '{UPPER.lower()}'"
# The reflected polynomial of CRC-32, a fixed value.
CRC_POLYNOMIAL = 0xEDB88320


def _crc_table() -> str:
    entries = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (CRC_POLYNOMIAL if value & 1 else 0)
        entries.append(str(value))
    return f"[{', '.join(entries)}]::BIGINT[]"


def shard_documents(shards: int = 40) -> str:
    return rf"""
WITH RECURSIVE jumps AS (
  SELECT doc_id, ((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616) AS state,
         -1::BIGINT AS last, 0::BIGINT AS next
  FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, turned, next, floor((next + 1) * (2147483648.0::DOUBLE / ((turned // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (state * {MULTIPLIER}::HUGEINT + 1) % 18446744073709551616 AS turned FROM jumps WHERE next < {shards})
),
placed AS (SELECT doc_id, last::INT AS shard, (CASE next WHEN {shards} THEN {shards} ELSE last END)::INT AS grown_shard
           FROM jumps WHERE next >= {shards}),
crc_table AS (SELECT {_crc_table()} AS entries),
bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS octets
  FROM documents
),
summed AS (
  SELECT doc_id, size,
         xor(list_reduce(list_prepend(4294967295, octets),
             lambda sum, octet: xor(sum >> 8, entries[xor(sum & 255, octet) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM summed JOIN placed USING (doc_id)"""


def _quality(options: QualityOptions) -> str:
    return rf"""
texts AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '{SPACE}+'), lambda w: w <> '') AS w
  FROM documents
),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS run FROM texts, unnest(range(1, len(w) - 3)) AS r(i)
),
repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM repeated, unnest(range(5)) AS o(k) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: trim(l, {TRIM}) <> '') AS l FROM texts
),
measured AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
),
base AS (
  SELECT *, n_words < {options.min_words} OR 100 * n_repeat_words > {options.max_repeat_percent} * n_words AS base_failed
  FROM measured
),
hosts AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS k FROM base GROUP BY host),
moments AS (SELECT avg(k / n) AS mean, var_pop(k / n) AS variance FROM hosts),
prior AS (
  SELECT mean, least(greatest(CASE WHEN variance > 0 THEN mean * (1 - mean) / variance - 1 ELSE {options.max_prior} END,
                              {options.min_prior}), {options.max_prior}) AS weight FROM moments
),
rates AS (SELECT host, (k + mean * weight) / (n + weight) AS rate FROM hosts, prior)"""


def judge_documents(options: QualityOptions = QualityOptions()) -> str:
    return f"""
WITH {_quality(options)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= {options.max_host_rate} AS kept, round(rate, 9) AS host_rate
FROM base JOIN rates USING (host)"""


def _listed(values: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in values)


def judge_urls() -> str:
    hosts = _listed([(r.name, r.host, r.path, r.verdict) for r in HOST_RULES])
    patterns = _listed([(r.pattern, r.regex(), r.verdict) for r in PATTERN_RULES])
    return rf"""
WITH host_rules(rule, rule_host, prefix, verdict) AS (VALUES {hosts}),
pattern_rules(rule, regex, verdict) AS (VALUES {patterns}),
urls AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1), {LOWER}) AS host,
         regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
by_host AS (
  SELECT page_id, max({{'length': length(rule), 'rule': rule, 'verdict': verdict}}) AS best
  FROM urls JOIN host_rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix)
  GROUP BY page_id
),
by_pattern AS (
  SELECT page_id, min({{'verdict': verdict, 'rule': rule}}) AS best
  FROM urls JOIN pattern_rules ON regexp_matches(translate(url, {LOWER}), regex) GROUP BY page_id
)
SELECT page_id, host, path, h.best.rule AS rule, coalesce(h.best.verdict, p.best.verdict, 'allow') AS verdict,
       p.best.rule AS pattern
FROM urls LEFT JOIN by_host h USING (page_id) LEFT JOIN by_pattern p USING (page_id)"""


def label_documents(size: int = 2, percent: int = 80) -> str:
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {LOWER}), '{SPACE}+'),
                             lambda w: w <> '') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS s FROM texts, unnest(range(1, len(w) - {size - 2})) AS r(i)
  WHERE len(w) >= {size}
  UNION ALL SELECT doc_id, 'whole ' || array_to_string(w, ' ') FROM texts WHERE len(w) BETWEEN 1 AND {size - 1}
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * k >= {percent} * (a.n + b.n - k)
),
reached AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u),
lowest AS (SELECT u AS doc_id, min(v) AS component_id FROM reached GROUP BY u)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM lowest LEFT JOIN sizes USING (doc_id)"""


def dedup_lines(min_chars: int = 20, min_docs: int = 3) -> str:
    return rf"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (
  SELECT doc_id, i, l[i] AS line, translate(trim(l[i], {TRIM}), {LOWER}) AS key
  FROM texts, unnest(range(1, len(l) + 1)) AS r(i)
),
common AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= {min_chars} GROUP BY key
  HAVING count(DISTINCT doc_id) >= {min_docs}
),
marked AS (
  SELECT doc_id, i, line, last IS NOT NULL AND last <> doc_id AS gone FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def write_and_read() -> str:
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    return rf"""
WITH hashed AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS h FROM pages),
coded AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes,
         array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform([15, 10, 5, 0], lambda shift:
           substr({letters}, ((('0x' || substr(h, 5 * k + 1, 5))::BIGINT >> shift) & 31) + 1, 1)), '')), '') AS payload_digest
  FROM hashed
),
paired AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM coded)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM paired"""


def best_phrases(least: int = 10, top: int = 2000) -> str:
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), {LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
listed AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM listed, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS r(i)
),
counts AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {least}),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.w, cut, l.f AS l, r.f AS r,
         1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, a FROM candidates, unnest([1, 2]) AS o(i) WHERE k = 3
),
longer AS (SELECT lang, phrase, max(a) AS most FROM inner_parts GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
         score::BIGINT AS score
  FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""


def cluster_vectors(clusters: int = 8, rounds: int = 10, seed: str = "3") -> str:
    squared = "list_sum(list_transform(range(1, 65), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT"

    def assigned(number: int) -> str:
        return f"""
a{number} AS MATERIALIZED (
  SELECT i, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': {squared}, 'cluster': cluster}}) AS best
  FROM kept, c{number} GROUP BY i
)"""

    def moved(number: int) -> str:
        return f"""
c{number + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM c{number} LEFT JOIN (
    SELECT cluster, list((total - ((total % size) + size) % size) // size ORDER BY j)::BIGINT[] AS m FROM (
      SELECT best.cluster AS cluster, j, sum(v[j]) AS total, count(*) AS size FROM a{number}, unnest(range(1, 65)) AS r(j) GROUP BY ALL
    ) GROUP BY cluster
  ) USING (cluster)
)"""

    steps = ",".join(assigned(n) + "," + moved(n) for n in range(rounds)) + "," + assigned(rounds)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS cluster, v AS c
  FROM kept QUALIFY cluster < {clusters}
),{steps},
sums AS (SELECT best.cluster AS cluster, sum(best.d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY ALL)
SELECT vec_id, cluster::INT AS cluster, best.d AS distance, cluster_inertia,
       (SELECT sum(cluster_inertia) FROM sums)::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM (SELECT vec_id, best, best.cluster AS cluster FROM a{rounds}) JOIN sums USING (cluster) JOIN c{rounds} USING (cluster)"""


STATEMENTS = {
    "op1_sharding": shard_documents(),
    "op3_line_dedup": dedup_lines(),
    "op5_quality_rules": judge_documents(),
    "op6_warc": write_and_read(),
    "op8_minhash_neardup": label_documents(),
    "op9_url_filters": judge_urls(),
    "op11_phrase_mining": best_phrases(),
    "op13_centroids": cluster_vectors(),
}
