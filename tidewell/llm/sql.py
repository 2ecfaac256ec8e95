"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from tidewell.llm import mixing, rules
from tidewell.llm.decontam import CONTAINED, SHINGLE

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[a-z0-9\x{{80}}-\x{{10FFFF}}]+')"

CONTAINMENT_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
parts AS (
  SELECT DISTINCT item_id, len(w) AS n, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM parts GROUP BY item_id),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE - 1} + 1)) AS i FROM docs WHERE len(w) >= {SHINGLE})
),
hits AS (SELECT doc_id, item_id, count(*) AS n_shared FROM grams JOIN parts USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, round(n_shared / n_shingles, 6) AS containment
FROM hits JOIN sizes USING (item_id) WHERE n_shared >= {CONTAINED} * n_shingles
"""


def mixing_sql(keep: float = 0.5) -> str:
    """Raking, calibration and sampling of ``mixing.mix_report``, every step written out."""
    dims = ("source", "lang", "topic")
    size = "greatest(length(text), 1)"
    share = lambda chars: f"(length(text) - length(regexp_replace(text, '[{chars}]', '', 'g'))) / {size}"
    parts = [
        f"""rows AS (
  SELECT doc_id, coalesce(source, '{mixing.UNKNOWN}') AS source, coalesce(lang, '{mixing.UNKNOWN}') AS lang,
    CASE WHEN {share('|')} >= 0.02 THEN 'table' WHEN {share('!')} >= 0.02 THEN 'shout'
         WHEN {share('0-9')} >= 0.005 THEN 'figures' ELSE 'prose' END AS topic,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM (SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents)
)""",
        "cells AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM rows GROUP BY ALL)",
    ]
    for dim in dims:
        listed = mixing.DEFAULT_SHARES[dim]
        case = " ".join(f"WHEN '{k}' THEN {float(v)}::DOUBLE" for k, v in (listed or {}).items())
        case = f"CASE {dim} {case} END" if listed else "NULL::DOUBLE"
        parts.append(f"""goal_{dim} AS (
  SELECT level, CASE WHEN rest > 0 THEN raw WHEN given > 0 THEN raw / given ELSE 0 END AS goal
  FROM (SELECT *, coalesce(CASE WHEN is_full THEN listed / given * (1 - unlisted) ELSE listed END,
            CASE WHEN rest > 0 THEN CASE WHEN is_full THEN unlisted ELSE greatest(1 - given, 0) END * own / rest END, 0) AS raw
        FROM (SELECT *, rest > 0 AND given >= 1 - {mixing.LEAST_LEFT}::DOUBLE AS is_full
              FROM (SELECT *, coalesce(sum(listed) OVER (), 0) AS given, coalesce(sum(own) OVER (), 0) AS rest,
                      coalesce(sum(CASE WHEN listed IS NULL THEN t END) OVER (), 0) / sum(t) OVER () AS unlisted
                    FROM (SELECT level, listed, t, CASE WHEN listed IS NULL THEN pow(t, {mixing.SOURCE_POWER}) END AS own
                          FROM (SELECT {dim} AS level, {case} AS listed, sum(tokens)::DOUBLE AS t FROM cells GROUP BY {dim} HAVING sum(tokens) > 0)))))
)""")
    goals = "".join(f" JOIN goal_{d} AS g_{d} ON g_{d}.level = c.{d}" for d in dims)
    parts.append(
        "w0 AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, "
        + ", ".join(f"g_{d}.goal AS goal_{d}" for d in dims)
        + f", c.tokens / (SELECT sum(tokens)::DOUBLE FROM cells) AS weight FROM cells AS c{goals} WHERE c.tokens > 0)"
    )
    at = 0
    for _ in range(mixing.ROUNDS):
        for dim in dims:
            parts.append(
                f"w{at + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens, goal_source, goal_lang, goal_topic, "
                f"CASE WHEN sum(weight) OVER (PARTITION BY {dim}) > 0 THEN weight * goal_{dim} / sum(weight) OVER (PARTITION BY {dim}) ELSE 0 END AS weight "
                f"FROM w{at})"
            )
            at += 1
    parts.append(f"rated AS MATERIALIZED (SELECT source, lang, topic, tokens, weight, weight / tokens AS ratio FROM w{at})")
    # cells in the order in which they are taken whole: the scale lies before the first one that the budget does not reach
    parts.append(f"""pieces AS MATERIALIZED (
  SELECT tokens / weight AS whole_at, weight, {keep}::DOUBLE * (SELECT sum(tokens) FROM cells)
      - coalesce(sum(tokens) OVER (ORDER BY tokens / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unspent,
    sum(weight) OVER (ORDER BY tokens / weight DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS left_weight
  FROM rated WHERE weight > 0
)""")
    parts.append("scale AS MATERIALIZED (SELECT coalesce(arg_min(unspent / left_weight, whole_at) FILTER (unspent / left_weight <= whole_at), max(whole_at)) AS s FROM pieces)")
    parts.append("final AS (SELECT source, lang, topic, weight, least(1.0::DOUBLE, ratio * s) AS p FROM rated, scale)")
    return f"""WITH {", ".join(parts)},
joined AS (
  SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, r.u, coalesce(f.weight, 0) AS weight,
    CASE WHEN r.n_tokens > 0 THEN coalesce(f.p, 0) ELSE 0 END AS p
  FROM rows AS r LEFT JOIN final AS f ON r.source = f.source AND r.lang = f.lang AND r.topic = f.topic
)
SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS cell_share, round(p, 6) AS probability, u < p AS sampled FROM joined"""


WARC_SQL = """
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT payload_digest, min(page_id) AS f FROM rows WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN f IS NOT NULL AND page_id IS DISTINCT FROM f THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f IS NOT NULL AND page_id IS DISTINCT FROM f THEN f END AS refers_to
FROM rows LEFT JOIN firsts USING (payload_digest)
"""


def rules_sql() -> str:
    """Measures and threshold table of ``rules.judge``."""
    stops = ", ".join("'" + w + "'" for w in sorted({w for listed in rules.STOP_WORDS.values() for w in listed}))

    def broken(rule: rules.Rule) -> str:
        value = f"{rule.over}::DOUBLE" + (f" / greatest({rule.under}, 1)::DOUBLE" if rule.under else "")
        limits = ([f"{value} < {rule.least}::DOUBLE"] if rule.least is not None else []) + (
            [f"{value} > {rule.most}::DOUBLE"] if rule.most is not None else []
        )
        return "(" + " OR ".join(limits) + ")"

    names = ", ".join(f"CASE WHEN {broken(r)} THEN '{r.name}' END" for r in rules.RULES)
    hard = " OR ".join(broken(r) for r in rules.RULES if r.base)
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
),
cut AS (
  SELECT row_no, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts
),
windows AS (
  SELECT row_no, i, count(*) OVER (PARTITION BY row_no, g) AS times
  FROM (SELECT row_no, i, array_to_string(w[i:i + {rules.WINDOW - 1}], ' ') AS g
        FROM (SELECT row_no, w, unnest(range(1, len(w) - {rules.WINDOW - 1} + 1)) AS i FROM cut WHERE len(w) >= {rules.WINDOW}))
),
repeats AS (
  SELECT row_no, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (SELECT unnest(range({rules.WINDOW})) AS k) WHERE times > 1 GROUP BY row_no
),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines,
    len(list_filter(lines, lambda l: rtrim(l, ' ') LIKE '%...' OR rtrim(l, ' ') LIKE '%…'))::BIGINT AS n_open_lines,
    len(list_filter(lines, lambda l: ltrim(l, ' ') LIKE '- %' OR ltrim(l, ' ') LIKE '* %' OR ltrim(l, ' ') LIKE '• %'))::BIGINT AS n_listed_lines,
    len(list_filter(w, lambda x: x IN ({stops})))::BIGINT AS n_stop_words
  FROM cut LEFT JOIN repeats USING (row_no)
),
judged AS (SELECT *, {hard} AS base_failed, list_filter([{names}], lambda x: x IS NOT NULL) AS wrong FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(wrong) = 0 AS kept,
  n_lines, n_open_lines, n_listed_lines, n_stop_words, array_to_string(wrong, ',') AS failed_rules
FROM judged
"""


SPELLING_SQL = """
WITH RECURSIVE crc_steps AS (
  SELECT b, b AS c, 0 AS k FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_steps WHERE k = 8),
found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 7 GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END)) AS b
  FROM counted
),
hashed AS (
  SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM bytes, crc_table
),
spelt AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) AS head, substr(word, i + 1) AS tail FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
links AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts AS a JOIN cuts AS b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION
  SELECT c.word, c.n, w.word, w.n FROM cuts AS c JOIN words AS w ON w.word = c.head || c.tail
  UNION
  SELECT w.word, w.n, c.word, c.n FROM cuts AS c JOIN words AS w ON w.word = c.head || c.tail
),
nearest AS (
  SELECT word, n, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM links GROUP BY word, n
),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words AS w LEFT JOIN nearest AS x ON w.word = x.word
),
walk AS (
  SELECT word, word AS root, form AS following FROM forms
  UNION ALL
  SELECT walk.word, walk.following, f.form FROM walk JOIN forms AS f ON f.word = walk.following WHERE walk.following IS NOT NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM forms AS f JOIN walk ON walk.word = f.word WHERE walk.following IS NULL
"""
