"""Check SQL of the operators that SQL can express on whole tables."""

LINE_DEDUP = """WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
  FROM (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS l FROM documents)),
filled AS (
  SELECT *, row_number() OVER d AS k, length(line) AS n, SUM(length(line)) OVER d AS upto
  FROM lines WHERE line <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
near AS (
  SELECT a.doc_id, a.k AS s, b.k AS e FROM filled a JOIN filled b
  ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 39 AND b.upto - a.upto + a.n >= 40),
windows AS (
  SELECT doc_id, s, MIN(e) AS e FROM near GROUP BY doc_id, s UNION SELECT doc_id, MAX(s) AS s, e FROM near GROUP BY doc_id, e),
texts AS (
  SELECT w.doc_id, s, e, string_agg(line, chr(10) ORDER BY k) AS t
  FROM windows w JOIN filled f ON w.doc_id = f.doc_id AND k BETWEEN s AND e GROUP BY ALL),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS nth FROM texts) WHERE nth > 1),
gone AS (SELECT DISTINCT f.doc_id, f.i FROM filled f JOIN later w ON f.doc_id = w.doc_id AND f.k BETWEEN w.s AND w.e),
flagged AS (
  SELECT l.*, CASE WHEN l.line <> '' THEN g.i IS NOT NULL END AS flag FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i),
marked AS (
  SELECT doc_id, line, i, CASE WHEN before IS NULL AND after IS NULL THEN FALSE ELSE COALESCE(before, TRUE) AND COALESCE(after, TRUE) END AS gone
  FROM (SELECT *, last_value(flag IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS before,
    first_value(flag IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
    FROM flagged)),
edged AS (SELECT *, gone AND NOT COALESCE(LAG(gone) OVER (PARTITION BY doc_id ORDER BY i), FALSE) AS opens FROM marked)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_removed, COUNT(*) FILTER (opens) AS n_runs,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM edged GROUP BY doc_id"""

_WORD = r"[^\x20\x09-\x0D]+"

QUALITY_RULES = rf"""WITH texts AS (
  SELECT doc_id, source, COALESCE(text, '') AS t, regexp_extract_all(COALESCE(text, ''), '{_WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
windows AS (
  SELECT *, COUNT(*) OVER (PARTITION BY doc_id, word, b, c) AS times
  FROM (SELECT *, LEAD(word) OVER d AS b, LEAD(word, 2) OVER d AS c FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i))
  WHERE c IS NOT NULL),
repeats AS (
  SELECT doc_id, COUNT(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(n_repeat_words, 0) AS n_repeat_words, COALESCE(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols > 0.3 * greatest(n_words, 1) OR n_dup_lines > 0.5 * greatest(n_lines, 1)
      OR word_chars < 2 * greatest(n_words, 1) OR word_chars > 15 * greatest(n_words, 1) AS loose,
    n_symbols > 0.1 * greatest(n_words, 1) OR n_dup_lines > 0.3 * greatest(n_lines, 1)
      OR word_chars < 3 * greatest(n_words, 1) OR word_chars > 10 * greatest(n_words, 1) AS strict FROM counts),
hosts AS (SELECT source, COUNT(*) AS n, COUNT(*) FILTER (base_failed OR loose) AS f FROM judged GROUP BY source),
fitted AS (
  SELECT least(greatest(AVG(f / n), 1e-4), 1 - 1e-4) AS m, var_pop(f / n) AS spread, AVG(1 / n) AS inverse FROM hosts),
prior AS (
  SELECT m, least(greatest(m * (1 - m) / greatest(spread - m * (1 - m) * inverse, m * (1 - m) / 1e4) - 1, 2), 1e4) AS s FROM fitted),
rates AS (SELECT source, (f + m * s) / (n + s) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(rate, 6) AS host_rate, rate > 0.5 AS host_failed, NOT (base_failed OR loose OR rate > 0.5 AND strict) AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source"""


def _spans(kind: int, pattern: str, group: int) -> str:
    """Matches with their positions: the lengths of the pieces between matches and of the matches before."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, source, {kind} AS kind_no, m[k] AS value,
  list_sum([length(x) for x in between[1:k]]) + COALESCE(list_sum([length(x) for x in whole[1:k - 1]]), 0) AS start, length(whole[k]) AS size
FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS k FROM (
  SELECT doc_id, source, string_split_regex(COALESCE(text, ''), '{quoted}') AS between,
    regexp_extract_all(COALESCE(text, ''), '{quoted}') AS whole, regexp_extract_all(COALESCE(text, ''), '{quoted}', {group}) AS m
  FROM documents WHERE regexp_matches(text, '{quoted}')))"""


def secret_scans(assign: str, access: str, hexes: str, opaque: str) -> str:
    return f"""WITH base AS (
  SELECT * FROM ({_spans(0, assign, 2)}) WHERE length(value) >= 8
  UNION ALL {_spans(1, access, 0)} UNION ALL {_spans(2, hexes, 0)}),
bare AS (
  SELECT * FROM ({_spans(3, opaque, 0)}) o
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.start < o.start + o.size AND o.start < b.start + b.size)),
found AS (SELECT * FROM base UNION ALL SELECT * FROM bare),
owned AS (SELECT value, COUNT(DISTINCT COALESCE(source, chr(0))) < 3 AS live FROM found GROUP BY value),
spans AS (
  SELECT *, ['assign', 'access', 'hex', 'opaque'][kind_no + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span
  FROM found JOIN owned USING (value) WHERE live OR kind_no < 3)
SELECT d.doc_id, COUNT(*) FILTER (kind_no = 0) AS n_assign, COUNT(*) FILTER (kind_no = 1) AS n_access, COUNT(*) FILTER (kind_no = 2) AS n_hex,
  sha256(COALESCE(string_agg(span, ',' ORDER BY start, kind_no) FILTER (kind_no < 3), '')) AS base_sha256,
  COALESCE(string_agg(span, ',' ORDER BY start, kind_no), '') AS spans, COUNT(*) FILTER (live) AS n_live
FROM documents d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id"""


MINHASH = rf"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [w[i:i + 2] for i in range(1, len(w) - 1)]
    WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM texts),
numbered AS (SELECT doc_id, hash(s) AS s FROM shingles),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, s.b FROM reach r JOIN steps s ON r.b = s.a)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)"""


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    lower = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"SELECT {key}, unnest(regexp_extract_all({lower}, '{_TERM}')) AS term FROM {table}"


LEXICAL_SEARCH = f"""WITH terms AS ({_terms('documents', 'doc_id')}),
tfs AS (SELECT doc_id, term, COUNT(*) AS tf FROM terms GROUP BY ALL),
lengths AS (SELECT doc_id, SUM(tf)::BIGINT AS n FROM tfs GROUP BY ALL),
totals AS (SELECT COUNT(*) AS docs, SUM(n)::BIGINT AS total FROM lengths),
norms AS (SELECT doc_id, 100 - 90 + ((90 * n * docs) // total) AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, COUNT(*) AS df FROM tfs GROUP BY ALL), totals),
asked AS (SELECT DISTINCT item_id, term FROM ({_terms('benchmark', 'item_id')})),
scores AS (
  SELECT item_id, doc_id, SUM(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM scores WHERE score > 0)
SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= 10"""
