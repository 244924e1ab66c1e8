"""DuckDB SQL for the text operators that SQL can express, written from their contracts."""

from __future__ import annotations

from touchline.llm.licenses import BLOCK, PHRASES, STEP, TEMPLATES, THRESHOLD, template_pieces
from touchline.llm.mixing import SCHEDULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(rank: int, kind: str, pattern: str, group: int, least: int, more: str = "true") -> str:
    p = _literal(pattern)
    return f"""SELECT doc_id, owner, {rank} AS rank, '{kind}' AS kind, value, first,
        first + length(whole) AS past FROM (
      SELECT doc_id, owner, vals[i] AS value, hits[i] AS whole,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS first
      FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT doc_id, owner, string_split_regex(body, {p}) AS gaps, regexp_extract_all(body, {p}) AS hits,
          regexp_extract_all(body, {p}, {group}) AS vals FROM d WHERE regexp_matches(body, {p}))))
    WHERE length(value) >= {least} AND {more}"""


SECRETS = f"""
WITH d AS (SELECT doc_id, source AS owner, coalesce(text, '') AS body FROM documents),
spans AS (
  {_found(0, "assign", r'''((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', 2, 6)}
  UNION ALL {_found(1, "access", "AKIA[A-Z0-9]+", 0, 20)}
  UNION ALL {_found(2, "hex", "[0-9a-f]+", 0, 24)}
  UNION ALL {_found(3, "live", "[A-Za-z0-9+/_=-]+", 0, 20,
    "regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 10")}),
held AS (SELECT value, count(DISTINCT owner) + max(CASE WHEN owner IS NULL THEN 1 ELSE 0 END) AS owners,
    count(DISTINCT (owner, doc_id)) AS repositories
  FROM spans GROUP BY value),
kept AS (SELECT s.*, h.owners, h.repositories, h.owners <= 2 AND h.repositories <= 50 AS specific,
    kind || ':' || CAST(first AS BIGINT) || ':' || CAST(past AS BIGINT) AS shown
  FROM spans s JOIN held h USING (value)),
folded AS (SELECT doc_id,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(shown, ',' ORDER BY first, rank) FILTER (rank < 3) AS base,
    string_agg(shown, ',' ORDER BY first, rank) FILTER (rank < 3 OR specific) AS spans,
    count(*) FILTER (rank < 3 AND specific) AS n_specific, count(*) FILTER (rank < 3 AND NOT specific) AS n_copied,
    max(owners) AS most_owners, max(repositories) AS most_repositories
  FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_specific, 0) AS n_specific,
  coalesce(n_copied, 0) AS n_copied, CAST(coalesce(most_owners, 0) AS BIGINT) AS most_owners,
  coalesce(most_repositories, 0) AS most_repositories
FROM d LEFT JOIN folded USING (doc_id)
"""  # fmt: skip



def _time_of(schedule: tuple[float, ...], used: str) -> str:
    """When a weight schedule, linear between equally spaced times, has used up a share of its area."""
    steps = len(schedule) - 1
    areas = [(schedule[i] + schedule[i + 1]) / 2 for i in range(steps)]
    cases = []
    for i in range(steps):
        a, slope = schedule[i], schedule[i + 1] - schedule[i]
        rest = f"({used} - {sum(areas[:i]) / sum(areas)!r}::DOUBLE) * {sum(areas)!r}::DOUBLE"
        root = f"(sqrt(greatest({a * a!r}::DOUBLE + {2 * slope!r}::DOUBLE * ({rest}), 0)) - {a!r}::DOUBLE) / {slope!r}::DOUBLE"
        inside = root if slope else f"({rest}) / {a!r}::DOUBLE"
        cases.append(f"WHEN {used} <= {sum(areas[: i + 1]) / sum(areas)!r}::DOUBLE THEN ({inside} + {i}) / {steps}.0::DOUBLE")
    return f"CASE {' '.join(cases)} ELSE 1.0::DOUBLE END"


MIXING = rf"""
WITH d AS (SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    , row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
t AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
u AS (SELECT source, rank, source_size, least(2.0::DOUBLE * source_size, (max(level) OVER ()) * weight) AS target FROM t),
p AS (SELECT d.doc_id, d.size, u.rank, u.source_size, u.target,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS begins
  FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size, target, one + two AS taken, n_copies,
  round(CASE WHEN n_copies > 0 THEN CASE rank % 3 {" ".join(f"WHEN {i} THEN {_time_of(x, 'used')}" for i, x in enumerate(SCHEDULES))} END END, 9)
    AS first_position
FROM (SELECT *, CAST((one > 0)::INT + (two > 0)::INT AS BIGINT) AS n_copies,
    CASE WHEN one > 0 THEN begins + one / 2 ELSE begins + source_size + two / 2 END / greatest(round(target), 1) AS used
  FROM (SELECT *, CAST(greatest(0, least(size, round(target)::BIGINT - begins)) AS BIGINT) AS one,
      CAST(greatest(0, least(size, round(target)::BIGINT - begins - source_size)) AS BIGINT) AS two FROM p))
"""


def _phrase(phrase: str, label: str) -> str:
    parts = phrase.split(" ")
    same = " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(parts))
    return f"""list_transform(list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {same}),
      lambda i: {{'place': i, 'label': '{label}'}})"""


def _piece(number: int, label: str, words: list[str]) -> str:
    return f"({number}, '{label}', [{', '.join(map(_literal, words))}], {len(words)})"


LICENSES = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT doc_id, w, list_concat({", ".join(_phrase(*p) for p in PHRASES[:2])}) AS p1,
  list_concat({", ".join(_phrase(*p) for p in PHRASES[2:])}) AS p2 FROM d),
base AS (SELECT doc_id, w, list_concat(p1, p2) AS places FROM b),
templates(number, label, words, m) AS (VALUES {", ".join(_piece(n, *p) for n, p in enumerate(template_pieces(TEMPLATES)))}),
windows AS (SELECT doc_id, list_distinct(w[s:s + {BLOCK - 1}]) AS words FROM (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - {BLOCK - STEP}, 1) + 1, {STEP})) AS s FROM d)),
added AS (SELECT doc_id, list(DISTINCT label) AS added, max(shared / m) AS containment FROM (
    SELECT doc_id, label, m, len(list_intersect(windows.words, t.words)) AS shared FROM windows, templates t)
  WHERE shared >= ceil({THRESHOLD} * m - 1e-9) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(places, lambda p: p.place)) AS BIGINT) AS first_word,
  CAST(list_max(list_transform(places, lambda p: p.place)) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(places, lambda p: p.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda p: p.label), coalesce(added, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
FROM base LEFT JOIN added USING (doc_id)
"""  # fmt: skip

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM r),
l AS (SELECT *, length(role) + length(regexp_replace(role, '[^\\<\[]', '', 'g'))
    + length(text) + length(regexp_replace(text, '[^\\<\[]', '', 'g'))
    + length('<|im_start|><|im_sep|><|im_end|>') + 1 AS shown FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""

NEARDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
s AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM g),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n + b.n AS n, count(*) AS shared FROM s a JOIN s b USING (g)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT u, v FROM pairs WHERE 100 * shared >= 85 * (n - shared)),
reach(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
least_of AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT g.doc_id, CAST(len(g.g) AS BIGINT) AS n_shingles, component_id, g.doc_id = component_id AS kept
FROM g JOIN least_of USING (doc_id)
"""  # fmt: skip


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Lloyd rounds over components (p, j) of part p; entries are numbered e."""

    def nearest(book: str) -> str:
        return f"""SELECT vec_id, p, e, dist FROM (
      SELECT vec_id, p, e, dist, row_number() OVER (PARTITION BY vec_id, p ORDER BY dist, e) AS place FROM (
        SELECT c.vec_id, c.p, b.e, CAST(sum((c.x - b.y) * (c.x - b.y)) AS BIGINT) AS dist
        FROM comps c JOIN {book} b ON c.p = b.p AND c.j = b.j GROUP BY c.vec_id, c.p, b.e)) WHERE place = 1"""

    steps = []
    for r in range(rounds):
        steps.append(f"near{r} AS ({nearest(f'book{r}')})")
        steps.append(f"""mean{r} AS (SELECT p, e, j, (total - ((total % n) + n) % n) // n AS y FROM (
      SELECT a.p, a.e, c.j, CAST(sum(c.x) AS BIGINT) AS total, count(*) AS n
      FROM near{r} a JOIN comps c ON a.vec_id = c.vec_id AND a.p = c.p GROUP BY a.p, a.e, c.j))""")
        steps.append(f"""book{r + 1} AS (SELECT b.p, b.e, b.j, coalesce(m.y, b.y) AS y
      FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e AND b.j = m.j)""")
    return f"""
WITH kept AS (SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long AS (SELECT vec_id, len(v) // {parts} AS width, unnest(range(len(v))) AS i,
    unnest(list_transform(v, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS x FROM kept),
comps AS (SELECT vec_id, i // width AS p, i % width AS j, x FROM long),
heads AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept),
book0 AS (SELECT c.p, h.e, c.j, c.x AS y FROM comps c JOIN heads h USING (vec_id) WHERE h.e < {entries}),
{", ".join(steps)},
last AS ({nearest(f"book{rounds}")}),
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error
  FROM last GROUP BY vec_id),
labelled AS (SELECT c.*, k.label FROM coded c JOIN kept k USING (vec_id)),
books AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, j)) AS sha FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM labelled, books
"""


ORACLE = {
    "op1_secrets": SECRETS,
    "op2_mixing": MIXING,
    "op3_licenses": LICENSES,
    "op4_chat": CHAT,
    "op7_neardup": NEARDUP,
    "op12_codes": _codes(),
}
