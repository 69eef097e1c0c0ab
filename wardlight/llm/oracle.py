"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from wardlight.llm import centroids, mixing, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_CASES = " ".join(
    f"UNION ALL SELECT doc_id, lang, clean, '{rule}' AS rule, {step} AS step, {cut} AS cutoff, "
    f"{rule} > {cut} AS rejected FROM held"
    for rule, cuts in quality_rules.RULES.items() for step, cut in enumerate(cuts)
).removeprefix("UNION ALL ")

_N_RULES = len(quality_rules.RULES)
_SHARE = quality_rules.MAX_FALSE_REJECTION / _N_RULES

# The holdout is the whole labels table.
QUALITY_RULES = rf"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS} AS words FROM documents
), windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS three
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), found AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS n FROM windows)
  WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM found) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))
    AS lines FROM w
), counts AS (
  SELECT doc_id, lang, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM w JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), figures AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS}
      OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_share,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_share,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length
  FROM counts
), held AS (
  SELECT figures.*, clean FROM figures JOIN (
    SELECT doc_id, min(quality) > 0 AS clean FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
  ) USING (doc_id) WHERE NOT base_failed
), tries AS ({_CASES}), cells AS (
  SELECT lang, rule, step, cutoff, count(*) FILTER (clean) AS n,
    count(*) FILTER (clean AND rejected) AS k, count(*) FILTER (NOT clean AND rejected) AS junk
  FROM tries GROUP BY ALL
), tested AS (
  SELECT *, k <= n * {_SHARE} AND list_sum(list_transform(range(0, k + 1), lambda i: exp(
    lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_SHARE})
    + (n - i) * ln(1 - {_SHARE})))) <= {quality_rules.ERROR_LEVEL}
      / ({_N_RULES} * (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM cells)) AS passed
  FROM cells
), certified AS (
  SELECT *, bool_and(passed) OVER (PARTITION BY lang, rule ORDER BY step) AS certified FROM tested
), cuts AS (
  SELECT lang AS stratum, rule, arg_max(cutoff, (junk - k) * 1000 - step) AS cutoff
  FROM certified WHERE certified AND junk > k GROUP BY ALL
), judged AS (
  SELECT doc_id, list_sort(list(rule)) AS failed FROM (
    SELECT figures.doc_id, rule FROM figures JOIN cuts ON stratum IS NOT DISTINCT FROM lang
    WHERE cutoff < CASE rule WHEN 'symbol_share' THEN symbol_share WHEN 'repeat_share'
      THEN repeat_share WHEN 'dup_line_share' THEN dup_line_share ELSE word_length END
  ) GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed IS NULL AS kept
FROM figures LEFT JOIN judged USING (doc_id)
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')))
      AS place
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM totals
), ordered AS (
  -- sources by how soon they are full; before: caps and weights of those fuller
  SELECT *, 2 * source_size AS cap,
    coalesce(sum(2 * source_size) OVER earlier, 0) AS spent,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS left_weight,
    {mixing.BUDGET_SHARE}::DOUBLE * sum(source_size) OVER () AS budget
  FROM weighted
  WINDOW earlier AS (ORDER BY 2 * source_size / weight, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (SELECT (budget - spent) / left_weight FROM ordered
    WHERE cap > (budget - spent) / left_weight * weight
    ORDER BY cap / weight, source NULLS LAST LIMIT 1) AS level
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(level * weight, cap)) AS target
  FROM ordered CROSS JOIN level
), placed AS (
  SELECT sized.*, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
    sum(size) OVER (PARTITION BY sized.source ORDER BY place, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN upto - size / 2 <= target - whole * source_size THEN 1 ELSE 0 END)
  )::BIGINT AS taken
FROM placed
"""

URL_FILTER = r"""
WITH rules(verdict, host_end, path_start, rule) AS (VALUES
  ('allow', 'com', '/', 'com/'), ('block', 'example.com', '/en/', 'example.com/en/'),
  ('allow', 'www.example.com', '/en/', 'www.example.com/en/'), ('block', 'net', '/es/', 'net/es/'),
  ('block', 'net', '/fr/', 'net/fr/')
), rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
)
SELECT page_id, host, path,
  (SELECT arg_max(rule, length(rule)) FROM rules WHERE (host = host_end OR
    ends_with(host, '.' || host_end)) AND starts_with(path, path_start)) AS rule,
  coalesce((SELECT arg_max(verdict, length(rule)) FROM rules WHERE (host = host_end OR
    ends_with(host, '.' || host_end)) AND starts_with(path, path_start)), 'allow') AS verdict
FROM parts
"""

DECONTAMINATION = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size,
    array_to_string(words[i:i + 9], ' ') AS key
  FROM (SELECT *, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM items
        WHERE len(words) > 0)
), places AS (
  SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS key
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM words CROSS JOIN (SELECT DISTINCT size FROM windows))
), found AS (SELECT doc_id, item_id, i, size FROM places JOIN windows USING (size, key)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS key
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS i FROM w)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT *, min(doc_id) OVER (PARTITION BY key) AS least FROM windows
  ) WHERE doc_id > least
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM repeated),
words AS (
  SELECT doc_id, place, words[place] AS word
  FROM (SELECT *, unnest(range(1, len(words) + 1)) AS place FROM w)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
strings AS (
  SELECT doc_id, i, substr(body, 2 * i + 1, 200) AS key
  FROM (SELECT *, unnest(range(0, len(body) // 2 - 99)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS n FROM strings
  ) WHERE n > 1
), steps AS (
  SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, 0) AS after,
    lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL AS leads
  FROM repeated
), cut AS (
  SELECT doc_id, count(*) FILTER (leads OR i > after)::BIGINT AS n_spans,
    string_agg(substr(body, 2 * after + 1, 2 * greatest(0, i - after)), '' ORDER BY i)
      || substr(any_value(body), 2 * (max(i) + 100) + 1) AS kept
  FROM steps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(body) // 2)::BIGINT AS n_bytes,
  ((len(body) - len(coalesce(kept, body))) // 2)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, body))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

# Repetitions are stretches of places whose word stands again a period later.
WORD_RUNS = rf"""
WITH w AS (SELECT row_number() OVER () AS row, doc_id, {WORDS} AS words FROM documents),
sums AS (
  -- crc32 of the id's digits, bit by bit
  SELECT *, len(words) AS n, coalesce(xor(list_reduce(list_concat([4294967295::BIGINT], flatten(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_concat(
        [ascii(c)::BIGINT], list_transform(range(8), lambda i: -1::BIGINT))))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1
      THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END), 4294967295::BIGINT), 1) AS h FROM w
), dealt AS (
  SELECT row, doc_id, words, h % 10 = 0 AND n > 0 AS loops, (h // 10) % greatest(n, 1) AS a,
    1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM sums
), places AS (
  SELECT row, len(words) AS n, i, words[1 + CASE WHEN loops AND i >= a THEN a + (i - a) % p
    ELSE i END] AS word
  FROM (SELECT *, unnest(range(len(words))) AS i FROM dealt)
), again AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM places x JOIN places y
  ON x.row = y.row AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4
), stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM (
    SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS stretch FROM again
  ) GROUP BY row, q, stretch HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (
  SELECT row, start, length, min(q) AS period FROM stretches GROUP BY ALL
), figures AS (
  SELECT row, count(*) AS n_runs,
    list(struct_pack(start, length, period) ORDER BY start, period) AS all_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)
      AS lines FROM runs GROUP BY row
), tops AS (
  SELECT runs.* FROM runs JOIN (SELECT row, max(length / period) AS most FROM runs GROUP BY row)
  USING (row) WHERE length / period = most
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY start, period) = 1
), gone AS (
  SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS text
  FROM places ANTI JOIN gone USING (row, i) GROUP BY row
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start, length::BIGINT AS length, period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(text, '')) AS collapsed_sha256
FROM w LEFT JOIN figures USING (row) LEFT JOIN tops USING (row) LEFT JOIN kept USING (row)
"""

_ROUND = """a{r} AS MATERIALIZED (
  SELECT row, vec_id, v, struct_extract(best, 'c') AS c, struct_extract(best, 'd') AS d FROM (
    SELECT row, vec_id, v, arg_min(struct_pack(c := n, d := far), far * 100 + n) AS best FROM (
      SELECT row, vec_id, v, n, list_sum(list_transform(range(1, 65),
        lambda i: (v[i] - m[i]) * (v[i] - m[i])))::BIGINT AS far
      FROM kept CROSS JOIN c{r}
    ) GROUP BY ALL)
)"""
# The floor of a quotient, for // rounds towards zero.
_MOVE = """c{s} AS MATERIALIZED (
  SELECT n, coalesce(moved, m) AS m FROM c{r} LEFT JOIN (
    SELECT c AS n, list((total - ((total % size) + size) % size) // size ORDER BY i) AS moved
    FROM (SELECT c, i, sum(v[i])::BIGINT AS total, count(*) AS size
          FROM (SELECT *, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c
  ) USING (n)
)"""

CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS n,
    v AS m FROM kept QUALIFY n < {centroids.CENTROIDS}
), {", ".join(_ROUND.format(r=r) + ", " + _MOVE.format(r=r, s=r + 1)
             for r in range(centroids.ROUNDS))},
{_ROUND.format(r=centroids.ROUNDS)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
  (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: x::VARCHAR), ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} JOIN c{centroids.ROUNDS} ON n = c
"""
