"""DuckDB statements for the queries that SQL can express."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

OP1 = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS run
  FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0),
runs AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS run
  FROM texts, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) AS t(i)
  WHERE len(words) >= n),
hits AS (SELECT doc_id, i, n, item_id FROM runs JOIN windows USING (n, run)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

#: The measures, in thousandths.
MEASURES = """(VALUES ('symbols', symbols), ('dup_lines', dup_lines), ('repeats', repeats), ('word_length', word_length)) AS m(measure, value)"""


def width(value: str) -> str:
    """Of a value's bucket."""
    return f"(CAST(1 AS BIGINT) << greatest(0, length(ltrim(bin({value}), '0')) - 6))"


def shrunk(groups: str, towards: str, on: str) -> str:
    """The share of rows up to each bucket in millionths, by ``groups`` (column names, each followed by a comma), with
    1000 rows of the curve ``towards`` added."""
    names = [g.strip() for g in groups.split(",") if g.strip()]
    same = " AND ".join(f"c.{g} IS NOT DISTINCT FROM g.{g}" for g in names)
    columns = ", ".join(f"g.{g}" for g in names)
    return f"""
  SELECT {columns}, t.measure, t.bucket,
    (CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY {columns}, t.measure ORDER BY t.bucket) AS BIGINT) * 1000000 + t.share * 1000)
      // (CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY {columns}, t.measure) AS BIGINT) + 1000) AS share
  FROM (SELECT DISTINCT {", ".join(names)} FROM judged WHERE NOT base_failed) g
  JOIN {towards} t ON {on}
  LEFT JOIN (SELECT {groups} measure, bucket, count(*) AS n FROM measured WHERE NOT base_failed GROUP BY ALL) c
    ON {same} AND c.measure = t.measure AND c.bucket = t.bucket"""


OP4 = rf"""
WITH texts AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
  FROM texts, unnest(range(1, len(words) - 1)) AS t(i)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM windows, unnest(range(i, i + 3)) AS t(p) WHERE times > 1 GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, greatest(len(lines), 1) AS n_lines
  FROM texts LEFT JOIN repeated USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols * 1000 // greatest(n_words, 1) AS symbols, n_dup_lines * 1000 // n_lines AS dup_lines,
    n_repeat_words * 1000 // greatest(n_words, 1) AS repeats, word_chars * 1000 // greatest(n_words, 1) AS word_length
  FROM counts),
widths AS (
  SELECT doc_id, lang, source, base_failed, measure, value,
    {width("value")} AS width
  FROM judged, LATERAL (SELECT * FROM {MEASURES})),
measured AS (SELECT *, value - value % width + width - 1 AS bucket FROM widths),
every AS (
  SELECT measure, bucket, CAST(sum(n) OVER (PARTITION BY measure ORDER BY bucket) AS BIGINT) * 1000000
    // CAST(sum(n) OVER (PARTITION BY measure) AS BIGINT) AS share
  FROM (SELECT measure, bucket, count(*) AS n FROM measured WHERE NOT base_failed GROUP BY ALL)),
by_lang AS ({shrunk("lang,", "every", "true")}),
own AS ({shrunk("lang, source,", "by_lang", "t.lang IS NOT DISTINCT FROM g.lang")}),
quantiles AS (
  SELECT lang, source, measure, min(bucket) FILTER (share >= 150000) AS q15, min(bucket) FILTER (share >= 500000) AS q50,
    min(bucket) FILTER (share >= 850000) AS q85, min(bucket) FILTER (share >= 990000) AS q99
  FROM own GROUP BY lang, source, measure),
limits AS (
  SELECT lang, source, measure, CASE WHEN measure = 'word_length' THEN q15 - 6 * greatest(q50 - q15, {width("q15")}) ELSE 0 END AS low,
    CASE WHEN measure IN ('symbols', 'word_length') THEN q85 + 6 * greatest(q85 - q50, {width("q85")})
      ELSE q99 + 6 * greatest(q99 - q85, {width("q99")}) END AS high
  FROM quantiles),
outside AS (
  SELECT DISTINCT doc_id FROM measured m
  JOIN limits o ON m.lang IS NOT DISTINCT FROM o.lang AND m.source IS NOT DISTINCT FROM o.source AND m.measure = o.measure
  WHERE m.bucket < low OR m.bucket > high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM judged
"""

OP5 = r"""
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, conv_id * 7 + turn AS number, text,
    'call-' || CASE WHEN (conv_id * 7 + turn) % 17 = 0 THEN turn - 2 ELSE turn END AS call_id,
    'call-' || CASE WHEN (conv_id * 7 + turn) % 19 = 0 THEN turn + 2 ELSE turn - 2 END AS after,
    CASE WHEN (conv_id * 7 + turn) % 13 = 0 THEN 'unlisted' WHEN turn % 3 = 0 THEN 'search'
      WHEN turn % 3 = 1 THEN 'lookup' ELSE 'summarise' END AS name,
    (conv_id * 7 + turn) % 11 = 0 AS broken,
    CASE turn % 3
      WHEN 0 THEN '{"limit":' || turn || ',"query":' || to_json(text) || '}'
      WHEN 1 THEN '{"key":' || to_json(text) || ',"strict":true}'
      ELSE '{"max_words":' || length(text) || ',"text":' || to_json(text) || '}' END AS arguments
  FROM conversations WHERE role = 'assistant'),
ranked AS (
  SELECT *, CASE WHEN broken THEN 'arguments are not JSON' WHEN name = 'unlisted' THEN 'unknown tool unlisted' ELSE '' END AS problems,
    row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn) AS place FROM calls),
firsts AS (SELECT * FROM ranked WHERE place = 1),
results AS (
  SELECT conv_id, turn, 'call-' || (turn - 1) AS call_id, text AS content
  FROM conversations WHERE role <> 'assistant'),
depths AS (
  SELECT conv_id, call_id, CAST(0 AS BIGINT) AS depth FROM firsts f
  WHERE NOT EXISTS (SELECT 1 FROM firsts g WHERE g.conv_id = f.conv_id AND g.call_id = f.after)
  UNION ALL SELECT c.conv_id, c.call_id, d.depth + 1 FROM firsts c JOIN depths d ON c.conv_id = d.conv_id AND c.after = d.call_id)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, name, coalesce(c.turn, r.turn) AS turn, depth,
  CASE WHEN c.call_id IS NULL THEN 'no_call' WHEN depth IS NULL THEN 'cycle' WHEN problems <> '' THEN 'invalid'
    WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
  coalesce(problems, '') AS problems, CAST(1 AS BIGINT) AS n_same,
  CAST(CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_results,
  CASE WHEN NOT broken THEN '{"arguments":' || arguments || ',"id":' || to_json(c.call_id) || ',"name":' || to_json(name)
    || ',"result":' || CASE WHEN r.call_id IS NULL THEN 'null' ELSE to_json(content) END || '}' END AS record
FROM firsts c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
  LEFT JOIN depths d ON c.conv_id = d.conv_id AND c.call_id = d.call_id
UNION ALL
SELECT conv_id, call_id, name, turn, NULL, 'duplicate', problems, 1, 0,
  CASE WHEN NOT broken THEN '{"arguments":' || arguments || ',"id":' || to_json(call_id) || ',"name":' || to_json(name) || ',"result":null}' END
FROM ranked WHERE place > 1
"""

#: CRC-32 by its table, over the bytes of each distinct word.
OP11 = rf"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda x:
    list_reduce(range(8), lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, x)) AS steps),
texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
own AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM texts) GROUP BY ALL),
buckets AS (
  SELECT word, xor(4294967295, list_reduce(
      list_transform(range(1, length(hex(word)) // 2 + 1), lambda i: CAST('0x' || substr(hex(word), 2 * i - 1, 2) AS BIGINT)),
      lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8), 4294967295)) % 10000 AS bucket
  FROM (SELECT word FROM own UNION SELECT word FROM items), crc_table),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM own JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM items JOIN buckets USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s, (SELECT coalesce(sum(n), 0) FROM t) AS t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1) * CAST(totals.s + 10000 AS DOUBLE)
    / ((coalesce(s.n, 0) + 1) * CAST(totals.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket), totals),
weighed AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM own JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weighed USING (doc_id)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS fit
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= fit * 10 // 100 THEN place END AS rank
FROM placed
"""

ORACLES = {"op1_decontamination": OP1, "op4_quality_rules": OP4, "op5_tool_calls": OP5, "op11_resampling": OP11}
