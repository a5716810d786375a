"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

from tallybrook.llm import hamming, mixing, quality, quoting

WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _quotes() -> str:
    mark = r"^((?:[ \t]*>)+)"
    return rf"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, role, coalesce(text, '') AS text FROM conversations
), split AS (
  SELECT rid, unnest(string_split_regex(text, '\r?\n')) AS line,
    generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS j
  FROM m
), lines AS (
  SELECT rid, j, length(regexp_replace(regexp_extract(line, '{mark}', 1), '[ \t]', '', 'g')) AS level,
    regexp_replace(line, '{mark}[ \t]?', '') AS body
  FROM split
), around AS (
  SELECT *, lag(level) OVER w AS level_before, lag(body) OVER w AS body_before,
    coalesce(lead(level) OVER w, 0) AS level_after
  FROM lines WINDOW w AS (PARTITION BY rid ORDER BY j)
), runs AS (
  SELECT *, sum(CASE WHEN level_before IS NULL OR level <> level_before OR trim(body_before) = ''
    THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY j) AS run
  FROM around
), passages AS (
  SELECT rid, any_value(level) AS level, string_agg(body, ' ' ORDER BY j) AS body FROM runs GROUP BY rid, run
), own AS (
  SELECT rid, j, body FROM around
  WHERE level = 0 AND NOT (regexp_matches(body, {_text(quoting.INTRODUCES)}) AND level_after > 0)
), written AS (
  SELECT rid, string_agg(body, chr(10) ORDER BY j) AS body FROM own GROUP BY rid
), clean AS (
  SELECT kind, rid, level, trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS body FROM (
    SELECT 'said' AS kind, rid, 0 AS level, body FROM written
    UNION ALL SELECT 'said', rid, 0, body FROM passages WHERE level = 0
    UNION ALL SELECT 'said', rid, 0, body FROM own
    UNION ALL SELECT 'quoted', rid, level, body FROM passages WHERE level > 0
    UNION ALL SELECT 'line', rid, level, body FROM lines WHERE level > 0)
), keys AS (
  SELECT DISTINCT CASE WHEN kind = 'said' THEN 'said' ELSE 'quoted' END AS kind, c.rid, conv_id, turn, level, body
  FROM clean AS c JOIN m USING (rid)
  WHERE length(body) >= CASE kind WHEN 'line' THEN 12 ELSE 1 END AND conv_id IS NOT NULL AND turn IS NOT NULL
), said AS (
  SELECT conv_id, body, min(turn) AS origin FROM keys WHERE kind = 'said' GROUP BY conv_id, body
), links AS (
  SELECT q.conv_id, q.turn, count(*) AS n_linked,
    max(CASE WHEN level = 1 THEN {{'size': length(body), 'origin': origin}} END) AS best
  FROM keys AS q JOIN said USING (conv_id, body)
  WHERE kind = 'quoted' AND origin < q.turn GROUP BY q.conv_id, q.turn
), up AS (
  SELECT conv_id, turn, best.origin AS above FROM links WHERE best IS NOT NULL
  UNION ALL
  SELECT up.conv_id, up.turn, l.best.origin FROM up JOIN links AS l ON l.conv_id = up.conv_id
    AND l.turn = up.above WHERE l.best IS NOT NULL
), roots AS (SELECT conv_id, turn, min(above) AS root FROM up GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, role, coalesce(regexp_replace(w.body, '^\s+|\s+$', '', 'g'), '') AS text,
  (SELECT count(*) FROM passages AS p WHERE p.rid = m.rid AND level > 0 AND trim(body) <> '') AS n_quotes,
  coalesce(n_linked, 0) AS n_linked, best.origin AS parent_turn, coalesce(root, m.turn) AS thread_turn
FROM m LEFT JOIN written AS w USING (rid)
LEFT JOIN links AS l ON l.conv_id = m.conv_id AND l.turn = m.turn
LEFT JOIN roots AS r ON r.conv_id = m.conv_id AND r.turn = m.turn
"""


def _hamming() -> str:
    return f"""
WITH codes AS (
  SELECT DISTINCT vec_id AS id,
    array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS code
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), pairs AS (
  SELECT q.id AS query_id, c.id AS neighbor_id, hamming(q.code, c.code)::INTEGER AS distance
  FROM codes AS q, codes AS c WHERE q.id % 50 = 0 AND q.id <> c.id
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id))::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= {hamming.K}
"""


def _integral_sql() -> list[str]:
    out = ["0.0::DOUBLE"]
    for i in range(len(mixing.TIMES) - 1):
        width = mixing.TIMES[i + 1] - mixing.TIMES[i]
        out.append(f"({out[-1]} + (w[{i + 1}] + w[{i + 2}]) * {width / 2}::DOUBLE)")
    return out


def _time_sql() -> str:
    sums, cases = _integral_sql(), ""
    for i in range(len(mixing.TIMES) - 1):
        width = mixing.TIMES[i + 1] - mixing.TIMES[i]
        need = f"(share * {sums[-1]} - {sums[i]})"
        slope = f"((w[{i + 2}] - w[{i + 1}]) / {width}::DOUBLE)"
        root = f"sqrt(greatest(w[{i + 1}] * w[{i + 1}] + {slope} * {need} * 2, 0.0::DOUBLE))"
        cases += (
            f" WHEN share * {sums[-1]} < {sums[i + 1]} THEN {mixing.TIMES[i]}::DOUBLE "
            f"+ {need} * 2 / (w[{i + 1}] + {root})"
        )
    return f"least(CASE{cases} ELSE 1.0::DOUBLE END, 1.0::DOUBLE)"


def _demand_sql() -> str:
    """Words that the sources of one weight have given by ``time``."""
    sums, done = _integral_sql(), "0.0::DOUBLE"
    for i in range(len(mixing.TIMES) - 1):
        width = mixing.TIMES[i + 1] - mixing.TIMES[i]
        into = f"greatest(least(time, {mixing.TIMES[i + 1]}::DOUBLE) - {mixing.TIMES[i]}::DOUBLE, 0.0::DOUBLE)"
        slope = f"((w[{i + 2}] - w[{i + 1}]) / {width}::DOUBLE)"
        done = f"({done} + {into} * w[{i + 1}] + {into} * {into} * {slope} / 2)"
    return f"{done} / {sums[-1]}"


def _curriculum() -> str:
    share, of = mixing.SHARE
    schedules = ", ".join("[" + ", ".join(f"{x}::DOUBLE" for x in s) + "]" for s in mixing.SCHEDULES)
    weights = ", ".join(map(str, mixing.WEIGHTS))
    kinds = len(mixing.WEIGHTS)
    demand = " + ".join(
        ["0.0::DOUBLE"]
        + [
            f"coalesce({_demand_sql().replace('w[', f'k[{i + 1}].w[')} * k[{i + 1}].words::DOUBLE, 0)"
            for i in range(kinds)
        ]
    )
    return rf"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ' ' || coalesce(text, '')) AS key,
    CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s
  FROM documents
), src AS (
  SELECT s, sum(size)::BIGINT AS words, (row_number() OVER (ORDER BY s) - 1) % {kinds} AS kind FROM d GROUP BY s
), weighed AS (
  SELECT *, [{weights}][kind + 1]::BIGINT AS weight, [{schedules}][kind + 1] AS w FROM src
), filling AS (
  SELECT *, sum({mixing.MOST} * words) OVER o - {mixing.MOST} * words AS capped,
    sum(weight) OVER () - sum(weight) OVER o + weight AS weights, sum(words) OVER () AS total
  FROM weighed WINDOW o AS (ORDER BY words::DOUBLE / weight, s ROWS UNBOUNDED PRECEDING)
), unit AS (
  SELECT {share} * total - {of} * capped AS num, {of} * weights AS den FROM filling
  WHERE weight * ({share} * total - {of} * capped) <= {mixing.MOST} * words * {of} * weights
  ORDER BY words::DOUBLE / weight, s LIMIT 1
), goal AS (
  SELECT weighed.*, coalesce(least(({mixing.MOST} * words)::DOUBLE, weight::DOUBLE * num::DOUBLE / den::DOUBLE),
    ({mixing.MOST} * words)::DOUBLE) AS target
  FROM weighed LEFT JOIN unit ON true
), needed AS (SELECT *, round(target)::BIGINT AS need FROM goal),
perkind AS (SELECT kind, any_value(w) AS w, sum(need)::BIGINT AS words FROM needed GROUP BY kind),
allkinds AS (
  SELECT [(SELECT {{'w': w, 'words': words}} FROM perkind WHERE kind = 0)
    {''.join(f", (SELECT {{'w': w, 'words': words}} FROM perkind WHERE kind = {i})" for i in range(1, kinds))}] AS k
), begun AS (
  SELECT doc_id, size, words, target, need, w,
    coalesce(sum(size) OVER (PARTITION BY s ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      0)::BIGINT AS start
  FROM d JOIN needed USING (s)
), timed AS (
  SELECT *, CASE WHEN start < need THEN start::DOUBLE / need::DOUBLE END AS share FROM begun
), placed AS (SELECT *, {_time_sql()} AS time FROM timed)
SELECT doc_id, size, words AS source_size, target,
  (greatest(least(need - start, size), 0) + greatest(least(need - start - words, size), 0))::BIGINT AS taken,
  CASE WHEN share IS NOT NULL THEN floor({demand})::BIGINT END AS position
FROM placed, allkinds
"""


def _quality() -> str:
    count = lambda pattern: f"len(regexp_extract_all(l, {_text(pattern)}))"
    n, menu, loud = count(WORD), count(quality.MENU_MARK), count(r"[#*$%&<>]+|!!+")
    # Spelled out here: the rules of the query are not taken over.
    edge = r"[^\p{L}\p{N}]"
    notices = "|".join(
        [
            "all rights reserved",
            "privacy policy",
            "terms of use",
            "terms of service",
            "licensed under cc",
            "released under cc",
            "licensed under [^.]{0,60}licen[cs]e",
            "released under [^.]{0,60}licen[cs]e",
            "use cookies",
            "uses cookies",
            "accept cookies",
            "accept all cookies",
            "cookie policy",
            "cookie settings",
            "cookie consent",
            "enable javascript",
            "require javascript",
            "requires javascript",
            "javascript is disabled",
            "javascript is required",
        ]
    )
    asked = "click here|read more|sign in|sign up|login|log in|share this|share on|subscribe|powered by"
    prompts = f"len(regexp_extract_all(low, '{edge}({asked}){edge}'))"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), w AS (SELECT rid, regexp_extract_all(text, '{WORD}') AS ws FROM d),
words AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
three AS (
  SELECT rid, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c
  FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times FROM three WHERE c IS NOT NULL
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) AS o(k) WHERE times > 1 GROUP BY rid
), split AS (SELECT rid, l, ' ' || lower(l) || ' ' AS low FROM (
  SELECT rid, unnest(string_split(text, chr(10))) AS l FROM d)),
ruled AS (
  SELECT rid, l, {n} > 0 AS worded, {n} > 0 AND (
    ({n} < {quality.SHORT_LINE} AND NOT regexp_matches(l, {_text(quality.SENTENCE_END)}))
    OR ({loud} >= 3 AND {loud} * 2 >= {n}) OR ({menu} >= 3 AND {menu} * 4 >= {n})
    OR ({n} <= 30 AND (regexp_matches(low, '{edge}({notices}){edge}')
      OR ({prompts} * 6 >= {n} AND NOT regexp_matches(l, {_text(quality.SENTENCE_END)}))))) AS fails
  FROM split
), perdoc AS (
  SELECT rid, count(*) FILTER (worded) - count(DISTINCT l) FILTER (worded) AS n_dup_lines,
    count(*) FILTER (fails) AS n_failed_lines,
    coalesce(sum(length(l)) FILTER (NOT fails) + count(*) FILTER (NOT fails) - 1, 0) AS left_chars
  FROM ruled GROUP BY rid
), counted AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[{quality.SYMBOLS}]'))::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    n_failed_lines::BIGINT AS n_failed_lines, (length(text) - left_chars)::BIGINT AS lost_chars,
    length(text) AS chars
  FROM d JOIN w USING (rid) JOIN perdoc USING (rid) LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality.MAX_REPEAT_PERCENT}
    AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_failed_lines,
  lost_chars, NOT base_failed AND lost_chars * 100 <= chars * {quality.MAX_LOST_PERCENT} AS kept
FROM judged
"""


def _archive() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
groups AS (SELECT body, max(page_id) AS top FROM p WHERE strlen(body) >= 1000 GROUP BY body)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
  CASE WHEN top IS NULL OR top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN groups USING (body)
"""


def _dialogue() -> str:
    """Repairs by recursion over rows; a state is the cheapest ``cost, audit, body`` to reach it."""

    def said(body: str, line: str, first: bool) -> str:
        return line if first else f"{body} || chr(10) || {line}"

    def step(state: str, letter: str, cost: str, line: str | None, first: bool = False) -> str:
        body = f"{state}.body" if line is None else said(f"{state}.body", line, first)
        return (
            f"CASE WHEN {state} IS NOT NULL THEN "
            f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'body': {body}}} END"
        )

    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def row(state: str, name: str, first: bool) -> str:
        """Keep or change a row where ``name`` is to speak."""
        keep = step(state, "K", "extra", "role || ':' || text", first)
        change = step(state, "R", "extra + 1", f"'{name}:' || text", first)
        return f"CASE WHEN faulty THEN NULL WHEN role[1] = '{name[0]}' THEN {keep} ELSE {change} END"

    def insert(state: str, name: str, first: bool = False) -> str:
        return step(state, "I", "5", f"'{name}:'", first)

    def delete(state: str) -> str:
        return step(state, "D", "2", None)

    system = step("s0", "K", "extra", "role || ':' || text", True)
    space = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(key, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT) % 20 AS fault
  FROM given
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copies(n) WHERE fault <> 0
), numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    regexp_extract(text, '({space})[\x20\x09-\x0D]*$', 1) AS last
  FROM damaged
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen FROM numbered
), faults AS (
  SELECT *, last = '' AS blank, last <> '' AND seen AS duplicate,
    last <> '' AND NOT seen AND last NOT IN ('.', '!', '?') AS truncated,
    lag(role[1]) OVER (PARTITION BY c ORDER BY i) || role[1] AS pair
  FROM ordered
), rows AS (
  SELECT *, blank OR duplicate AS faulty, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faults
), walk AS (
  SELECT DISTINCT c, 0::BIGINT AS i, {{'cost': 0::BIGINT, 'audit': '', 'body': ''}} AS n0,
    NULL::STRUCT(cost BIGINT, audit VARCHAR, body VARCHAR) AS n1,
    NULL::STRUCT(cost BIGINT, audit VARCHAR, body VARCHAR) AS n2,
    NULL::STRUCT(cost BIGINT, audit VARCHAR, body VARCHAR) AS n3
  FROM rows
  UNION ALL
  SELECT c, i, {delete("s0")}, {least(delete("s1"), f"CASE WHEN NOT faulty AND role[1] = 's' THEN {system} END")},
    {least(delete("s2"), row("s0", "user", True), row("s1", "user", False), row("s3", "user", False))},
    {least(delete("s3"), row("s2", "assistant", False))}
  FROM (
    SELECT c, rows.i, role, text, faulty, extra, n0 AS s0, n1 AS s1,
      {least("n2", insert("n0", "user", True), insert("n1", "user"), insert("n3", "user"))} AS s2,
      {least("n3", insert("n2", "assistant"))} AS s3
    FROM walk JOIN rows USING (c) WHERE rows.i = walk.i + 1
  )
), ends AS (
  SELECT c, {least("n0", "n3", insert("n2", "assistant"))} AS best
  FROM walk WHERE (c, i) IN (SELECT (c, max(i)) FROM rows GROUP BY c)
), counted AS (
  SELECT c, any_value(conv_id) AS conv_id,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY c
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(best.body, '')) AS repaired_sha256
FROM every LEFT JOIN (counted JOIN ends USING (c)) found ON found.conv_id IS NOT DISTINCT FROM every.conv_id
"""


ORACLE = {
    "op3_quotes": _quotes(),
    "op5_hamming": _hamming(),
    "op8_curriculum": _curriculum(),
    "op10_quality": _quality(),
    "op11_dialogue": _dialogue(),
    "op12_archive": _archive(),
}
