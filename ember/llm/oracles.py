"""DuckDB SQL of the registered queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d
), wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM starts
), least AS (
  SELECT win, min(doc_id) AS first_doc FROM wins GROUP BY win
), hit AS (
  SELECT DISTINCT wins.doc_id, wins.i + k.k AS pos
  FROM wins JOIN least ON wins.win = least.win AND least.first_doc < wins.doc_id,
       (SELECT unnest(range(0, 13)) AS k) k
), pos AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d
), kept AS (
  SELECT pos.doc_id, count(*) AS n_kept, string_agg(pos.word, ' ' ORDER BY pos.pos) AS txt
  FROM pos LEFT JOIN hit ON pos.doc_id = hit.doc_id AND pos.pos = hit.pos
  WHERE hit.pos IS NULL GROUP BY pos.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words,
       CAST(len(d.w) - coalesce(kept.n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.txt, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
""",
    "op2_bit_sliced": r"""
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), long AS (
  SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM q
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM long a JOIN long b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 GROUP BY 1, 2
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op5_setsketch": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM d
), n AS (
  SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), both_sets AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM both_sets JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= 85 * (a.n_shingles + b.n_shingles - shared)
), reach AS (
  SELECT x AS doc_id, y AS other FROM link
  UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON reach.other = link.x
), least_id AS (
  SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n_shingles, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(least_id.other, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(least_id.other, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_id ON least_id.doc_id = d.doc_id
""",
    "op8_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, len(text) + len(regexp_extract_all(text,
      '\[\\*(SYS|/SYS|INST|/INST|ASST|ROLE|TEXT|/ROLE)\]|<\\*/s>')) AS escaped,
    CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 10 ELSE 19 + len(role) END AS marks
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN len(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')) AS loss_sha256,
       CAST(sum(escaped + marks) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
""",
    # Runs by equal five-word windows a period apart; the id's crc32 bit by bit.
    "op11_periodic_runs": r"""
WITH s AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1)))) AS h
  FROM documents
), t AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM s
), u AS (
  SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM t
), d AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1]
    ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w
  FROM u
), win AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + 5], ' ') AS five
  FROM (SELECT doc_id, n, w, unnest(range(n - 4)) AS i FROM d WHERE n >= 6)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM win x JOIN win y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), marked AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 5 + q AS length FROM marked GROUP BY doc_id, q, island
), runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches
  WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS txt
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM d) p LEFT JOIN gone USING (doc_id, i)
  WHERE gone.i IS NULL GROUP BY p.doc_id
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place FROM runs
), listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS txt
  FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period,
  CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
  sha256(coalesce(l.txt, '')) AS runs_sha256, sha256(coalesce(k.txt, '')) AS collapsed_sha256
FROM d LEFT JOIN listed l ON d.doc_id = l.doc_id LEFT JOIN best b ON d.doc_id = b.doc_id AND b.place = 1
  LEFT JOIN kept k ON d.doc_id = k.doc_id
""",
}
