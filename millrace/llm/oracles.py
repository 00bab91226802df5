"""SQL twins of the operators that SQL can express, for DuckDB on the same tables."""

from __future__ import annotations

from millrace.llm import chat, quality, repair, spelling

# The table of the reflected polynomial 0xEDB88320, made by a rule.
_CRC_TABLE = """
crc AS (
  SELECT list(value ORDER BY byte) AS tab FROM (
    SELECT byte, list_reduce(list_prepend(byte, range(8)), lambda x, step:
                   CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS value
    FROM (SELECT unnest(range(256)) AS byte)))"""


def _crc32(text: str) -> str:
    """SQL: the unsigned crc32 of a text's UTF-8 bytes; needs the one row of ``crc`` beside it."""
    digit = "(instr('0123456789ABCDEF', substr(hex({0}), {1}, 1)) - 1)"
    byte = f"{digit.format(text, '2 * i - 1')} * 16 + {digit.format(text, '2 * i')}"
    bytes_ = f"list_transform(range(1, 1 + CAST(length(hex({text})) // 2 AS BIGINT)), lambda i: CAST({byte} AS BIGINT))"
    start = f"list_prepend(CAST(4294967295 AS BIGINT), {bytes_})"
    step = "xor(c >> 8, tab[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({start}, lambda c, b: {step}), 4294967295)"


_LETTERS = "[a-zÀ-ÿ]"

SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_LETTERS}+')) AS run
    FROM documents)
  WHERE length(run) >= {spelling.LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, times, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % {spelling.DAMAGE} = 0
                       THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed)
  WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}),
cut AS (
  SELECT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
forms AS (
  SELECT near.word, min(near.other) AS form, any_value(best_n) AS form_n
  FROM near JOIN best USING (word) JOIN words USING (word)
  WHERE other_n = best_n AND best_n >= {spelling.RATIO} * words.n GROUP BY near.word),
walk AS (
  SELECT word, word AS place FROM words
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.place)
SELECT words.word, forms.form, ends.place AS root, words.n, coalesce(best.n_near, 0) AS n_near, forms.form_n
FROM words LEFT JOIN best USING (word) LEFT JOIN forms USING (word)
JOIN (SELECT * FROM walk WHERE place NOT IN (SELECT word FROM forms)) ends USING (word)
"""

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
numbered AS (
  SELECT *, length(text) + length(role)
           + length(regexp_extract_all(role || ' ' || text, '[<\\[]\\\\*(/?s>|/?INST\\])')) + 20 AS chars,
         (length(text) + {chat.CODE_POINTS - 1}) // {chat.CODE_POINTS} + {chat.MARKS} AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
  FROM turns),
placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) - tokens AS gone,
         max(CASE WHEN n = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS lead
  FROM numbered),
started AS (
  SELECT conv_id, n, role, text, tokens, chars, lead,
         greatest({chat.BUDGET - chat.HISTORY} - lead, {chat.BUDGET // 4}) // 2 AS wide,
         CASE WHEN n = 1 AND role = 'system' THEN -1 ELSE gone - lead END AS start
  FROM placed),
windowed AS (
  SELECT *, CASE WHEN start < 0 THEN 1 WHEN tokens > wide THEN 2 * (start // wide) + 2
                 ELSE 2 * ((start + tokens - 1) // wide) + 1 END AS win
  FROM started),
openings AS (
  SELECT conv_id, win, win // {2 * chat.BLOCK_SLOTS} AS block, min(start) AS opens FROM windowed WHERE start >= 0 GROUP BY ALL),
written AS (
  SELECT conv_id, chars FROM windowed
  UNION ALL
  SELECT t.conv_id, t.chars FROM windowed t JOIN openings o
    ON t.conv_id IS NOT DISTINCT FROM o.conv_id AND t.win // {2 * chat.BLOCK_SLOTS} = o.block AND o.win > t.win
   AND t.start >= 0 AND o.opens BETWEEN t.start + 1 AND t.start + {chat.HISTORY}
  UNION ALL
  SELECT t.conv_id, t.chars FROM windowed t JOIN openings o
    ON t.conv_id IS NOT DISTINCT FROM o.conv_id AND t.start < 0 AND o.win > 1),
sizes AS (SELECT conv_id, CAST(sum(chars) AS BIGINT) AS formatted_chars FROM written GROUP BY conv_id)
SELECT t.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
       any_value(formatted_chars) AS formatted_chars
FROM numbered t JOIN sizes s ON t.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY t.conv_id
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _then(path: str, cost: str | int, initial: str) -> str:
    """SQL: a path (ten digits of cost, then the audit) after one more edit; NULL stays NULL."""
    return f"(lpad(CAST(CAST(substr({path}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({path}, 11) || {initial})"


_INSERTED = f"""
SELECT * EXCLUDE (user_, assistant), user_,
       least(assistant, {_then("user_", repair.INSERT, "'I'")}) AS assistant
FROM (SELECT * EXCLUDE (user_), least(user_, {", ".join(_then(s, repair.INSERT, "'I'") for s in ("nothing", "system_", "assistant"))}) AS user_
      FROM ({{}}))"""
_FREE = "fault IN ('clean', 'truncated')"
_LEFT = f"CASE WHEN fault = 'truncated' THEN {repair.UNFINISHED} ELSE 0 END"


def _taken(path: str, initial: str) -> str:
    """SQL: the path after the row is kept or given a role, where its fault lets it stay."""
    kept = _then(path, f"{_LEFT} + CASE WHEN first = '{initial}' THEN 0 ELSE {repair.REROLE} END", f"CASE WHEN first = '{initial}' THEN 'K' ELSE 'R' END")
    return f"CASE WHEN {_FREE} THEN {kept} END"


# DuckDB: one step per row of every conversation, the least path of each state as one string.
REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations, crc),
live AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM original WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         rtrim(text, {_BLANKS}) AS ended FROM live),
flagged AS (
  SELECT conv_id, n, role, text, substr(role, 1, 1) AS first,
         CASE WHEN ended = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'clean' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS odd
  FROM numbered),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, '0000000000' AS nothing, CAST(NULL AS VARCHAR) AS system_,
         CAST(NULL AS VARCHAR) AS assistant, CAST(NULL AS VARCHAR) AS user_ FROM flagged
  UNION ALL
  SELECT conv_id, n, {_then("nothing", repair.DELETE, "'D'")},
         least({_then("system_", repair.DELETE, "'D'")}, CASE WHEN first = 's' THEN {_taken("nothing", "s")} END),
         least({_then("assistant", repair.DELETE, "'D'")}, {_taken("user_", "a")}),
         least({_then("user_", repair.DELETE, "'D'")}, {", ".join(_taken(s, "u") for s in ("nothing", "system_", "assistant"))})
  FROM ({_INSERTED.format("SELECT w.conv_id, f.n, nothing, system_, assistant, user_, first, fault FROM walk w JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1")})),
ends AS (
  SELECT conv_id, least(nothing, assistant) AS path FROM ({_INSERTED.format("SELECT * FROM walk")})
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
letters AS (
  SELECT conv_id, i, substr(path, 10 + i, 1) AS edit, i - length(replace(substr(path, 11, i), 'I', '')) AS inserts
  FROM (SELECT conv_id, path, unnest(range(1, length(path) - 9)) AS i FROM ends)),
outputs AS (
  SELECT l.conv_id, i, edit, f.role, f.text, f.first,
         row_number() OVER (PARTITION BY l.conv_id ORDER BY i) AS place,
         first_value(edit = 'K' AND f.first = 's') OVER (PARTITION BY l.conv_id ORDER BY i) AS led
  FROM letters l LEFT JOIN flagged f ON edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.n = i - inserts
  WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(
           CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS hash
  FROM outputs GROUP BY conv_id),
counts AS (
  SELECT conv_id, count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
         count_if(fault = 'truncated') AS truncated, count_if(odd) AS illegal FROM flagged GROUP BY conv_id),
gaps AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps FROM live GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
       coalesce(CAST(substr(path, 1, 10) AS BIGINT), 0) AS cost, coalesce(substr(path, 11), '') AS audit,
       coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN gaps g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _components(nodes: str, links: str) -> str:
    """SQL tables: ``reach`` of all pairs that ``links`` (a, b, a < b) connect, ``part`` with the smallest of each node."""
    return f"""
reach AS (
  SELECT id AS node, id AS root FROM {nodes}
  UNION SELECT l.there, r.root FROM reach r JOIN
    (SELECT a AS here, b AS there FROM {links} UNION ALL SELECT b, a FROM {links}) l ON l.here = r.node),
part AS (SELECT node, min(root) AS component FROM reach GROUP BY node)"""


JACCARD = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id AS id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT id, unnest(CASE
           WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s
  FROM texts),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
links AS (
  SELECT a, b FROM (
    SELECT x.id AS a, y.id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.id < y.id GROUP BY ALL)
  JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
{_components("texts", "links")}
SELECT t.id AS doc_id, coalesce(n, 0) AS n_shingles, component AS component_id
FROM texts t JOIN part ON node = t.id LEFT JOIN sizes s ON s.id = t.id
"""

VECTORS = f"""
WITH RECURSIVE ids AS (SELECT vec_id AS id FROM embeddings),
usable AS (
  SELECT vec_id AS id, v, sqrt(list_dot_product(v, v)) AS norm
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL)
  WHERE len(v) > 0 AND len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(v, lambda e: e <> 0)) > 0),
links AS (
  SELECT x.id AS a, y.id AS b FROM usable x JOIN usable y ON x.id < y.id AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) >= 0.95 * x.norm * y.norm),
{_components("ids", "links")},
counts AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY id)
SELECT node AS vec_id, coalesce(n, 0) AS n_links, component AS component_id, node = component AS kept
FROM part LEFT JOIN counts ON counts.id = node
"""

_RE_WORD = r"[^\x20\x09-\x0D]+"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


def _failing(line: str) -> str:
    """SQL: whether a line fails, rule by rule as the docstring of ``quality.failing_line`` has them."""
    words = f"regexp_extract_all({line}, '{_RE_WORD}')"
    n = f"len({words})"
    separators = f"len(list_filter({words}, lambda w: regexp_full_match(w, '[|>»·•]')))"
    marks = f"len(list_filter({words}, lambda w: regexp_matches(w, '([!?][!?]+|{quality.SYMBOLS}{quality.SYMBOLS}+)$')))"
    rule = quality.SYMBOLS + r"|[{}\\_=~^]"
    navigation = f"({separators} > 0 AND {separators} * 4 >= {n})"
    punctuation = f"({_count(line, rule)} * 10 > length({line}) OR ({marks} > 0 AND {marks} * 3 >= {n} AND {n} >= 3))"
    odd = f"regexp_matches({line}, '[!?][!?]|[»·•]|{rule}')"
    shouted = f"({line} = upper({line}) AND {line} <> lower({line}) AND {n} >= 5)"
    furniture = f"(length({line}) <= 160 AND regexp_matches(lower({line}), '{'|'.join(quality.BOILERPLATE)}') AND {n} <= 12)"
    return f"(({odd} AND ({navigation} OR {punctuation})) OR {shouted} OR {furniture})"


QUALITY = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_RE_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_RE_WORD}')) AS full_lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS five
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM texts)),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows) WHERE times > 1)
  GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(full_lines) AS line FROM texts),
lost AS (SELECT doc_id, sum({_count("line", _RE_WORD)}) AS n FROM lines WHERE {_failing("line")} GROUP BY doc_id),
counted AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
         CAST({_count("text", quality.SYMBOLS)} AS BIGINT) AS n_symbols,
         CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_lost_words
  FROM texts t LEFT JOIN repeated r USING (doc_id) LEFT JOIN lost l USING (doc_id)),
judged AS (SELECT *, n_words < {quality.FEWEST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_lost_words <= {quality.MOST_LOST} * n_words AS kept, n_lost_words
FROM judged
"""
