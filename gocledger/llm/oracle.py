"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORDS = r"'[^\x20\x09-\x0D]+'"


def _alnum_words(text: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"COALESCE({text}, '')")}, {_ALNUM})"


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_alnum_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_alnum_words('text')} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, k, list_slice(w, i, i + k - 1) AS ws
    FROM (SELECT item, w, LEAST(10, len(w)) AS k, unnest(generate_series(1, len(w) - LEAST(10, len(w)) + 1)) AS i
          FROM b WHERE len(w) > 0) x
),
places AS (
    SELECT r, i, k, list_slice(w, i, i + k - 1) AS ws
    FROM (SELECT d.r, d.w, z.k, unnest(generate_series(1, len(d.w) - z.k + 1)) AS i
          FROM d, (SELECT DISTINCT k FROM win) z WHERE len(d.w) >= z.k) x
),
met AS (SELECT p.r, p.i, p.k, win.item FROM places p JOIN win ON win.ws = p.ws),
hit AS (SELECT r, COUNT(DISTINCT p) AS n
        FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM met) x GROUP BY r),
items AS (SELECT r, COUNT(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM met GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, COALESCE(hit.n, 0) AS n_hit, COALESCE(items.n, 0) AS n_items,
       sha256(COALESCE(items.s, '')) AS items_sha256, COALESCE(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN items ON items.r = d.r
"""

MIXING = f"""
WITH lab AS (SELECT doc_id, MAX(quality) AS q FROM labels GROUP BY doc_id),
doc AS (
    SELECT d.doc_id, d.source, COALESCE(len(regexp_extract_all(d.text, {_WORDS})), 0) AS size,
           -ln((CAST('0x' || substr(md5('8|' || COALESCE(CAST(d.doc_id AS VARCHAR), '') || '|' || COALESCE(md5(d.text), '')),
                                    1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
             / CASE lab.q WHEN 1 THEN 1.0 WHEN 0 THEN 0.25 ELSE 0.5 END AS key
    FROM documents d LEFT JOIN lab ON lab.doc_id = d.doc_id
),
src AS (
    SELECT source, SUM(size) AS n,
           [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1]::DOUBLE AS w
    FROM doc GROUP BY source
),
-- every source tried as the first that is not full: the rate per unit of weight that would leave
rate AS (
    SELECT MIN_BY(per, lim) AS per
    FROM (SELECT 2.0 * a.n / a.w AS lim,
                 (1.5 * (SELECT SUM(n) FROM src) - COALESCE(SUM(2.0 * z.n) FILTER (WHERE z.n / z.w < a.n / a.w), 0))
                   / SUM(z.w) FILTER (WHERE z.n / z.w >= a.n / a.w) AS per
          FROM src a, src z GROUP BY a.source, a.n, a.w) x
    WHERE lim > per
),
goal AS (
    SELECT source, n, t, CASE WHEN n > 0 THEN floor(t / n) ELSE 0 END AS e
    FROM (SELECT source, n, LEAST(2.0 * n, COALESCE((SELECT per FROM rate) * w, 2.0 * n)) AS t FROM src) x
),
run AS (
    SELECT d.doc_id, d.size, g.n, g.t, g.e, g.t - g.e * g.n AS rest,
           SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS upto
    FROM doc d JOIN goal g ON g.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, ROUND(t, 6) AS target,
       CAST(size * (e + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest <= rest - (upto - size))
                             THEN CASE WHEN rest > 0 THEN 1 ELSE 0 END ELSE 0 END) AS BIGINT) AS taken
FROM run
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (
    SELECT vec_id AS v, vec_id AS c FROM v
    UNION
    SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.v
)
SELECT v.vec_id, COALESCE((SELECT COUNT(*) FROM link WHERE link.a = v.vec_id), 0) AS n_links,
       (SELECT MIN(c) FROM reach WHERE reach.v = v.vec_id) AS component_id,
       v.vec_id = (SELECT MIN(c) FROM reach WHERE reach.v = v.vec_id) AS kept
FROM v
"""




def _crc32(text: str) -> str:
    """CRC-32 of a string of single-byte characters, bit by bit."""
    bits = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))"
    over = f"list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT))"
    return f"xor(list_reduce({over}, lambda c, b: {bits}), 4294967295)"


TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, c.vec_id,
       CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
FROM v q JOIN v c ON c.r <> q.r AND len(c.e) = len(q.e)
WHERE q.vec_id % 50 = 0
WINDOW w AS (PARTITION BY q.r ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 5
"""


def _encoded(value: str) -> str:
    return f"COALESCE(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _merkle(levels: int = 12, top_levels: int = 6) -> str:
    """Level by level (eight to a run): node digests, and each leaf's folded digest and siblings so far."""
    fields = [_encoded(f) for f in ("doc_id", "source", "lang", "n_chars")]
    leaf = " || ".join([*fields, _encoded("text")])
    low = " || ".join([*fields, _encoded(_LOWER.format("text"))])
    ctes = [f"""doc AS (
    SELECT row_number() OVER () AS r, doc_id, lang, sha256({leaf}) AS d,
           CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN sha256({low}) ELSE sha256({leaf}) END AS t
    FROM documents)""", """p0 AS (
    SELECT r, lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
           COUNT(*) OVER (PARTITION BY lang) AS n, t AS f, '' AS s, d FROM doc)""", "n0 AS (SELECT g, i, n, d FROM p0)"]

    def rise(node: str, path: str, height: int) -> None:
        for k in range(height):
            ctes.append(f"""{node}{k + 1} AS (
    SELECT g, i // 8 AS i, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE MIN(d) END AS d
    FROM {node}{k} GROUP BY g, n, i // 8)""")
            ctes.append(f"""{node}s{k} AS (
    SELECT g, i, n, COALESCE(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lo,
           COALESCE(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS hi
    FROM {node}{k} WINDOW w AS (PARTITION BY g, i // 8 ORDER BY i))""")
            ctes.append(f"""{path}{k + 1} AS (
    SELECT p.r, p.g, p.i // 8 AS i, (p.n + 7) // 8 AS n,
           CASE WHEN p.n > 1 THEN sha256(x.lo || p.f || x.hi) ELSE p.f END AS f, p.s || x.lo || x.hi AS s
    FROM {path}{k} p JOIN {node}s{k} x ON x.g IS NOT DISTINCT FROM p.g AND x.i = p.i)""")

    rise("n", "p", levels)
    ctes.append(f"""t0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, COUNT(*) OVER () AS n, d, g AS lang
    FROM n{levels})""")
    ctes.append(f"""q0 AS (SELECT p.r, 0 AS g, t0.i, t0.n, p.f, p.s, t0.d AS subroot
    FROM p{levels} p JOIN t0 ON t0.lang IS NOT DISTINCT FROM p.g)""")
    rise("t", "q", top_levels)
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc.doc_id, doc.d AS leaf, q0.subroot, root.d AS root, sha256(q.s) AS proof_sha256, q.f AS folded_root,
       q.f = root.d AS verified
FROM doc JOIN q0 ON q0.r = doc.r JOIN q{top_levels} q ON q.r = doc.r, (SELECT d FROM t{top_levels}) root
"""


def _conversations() -> str:
    """Least (cost, initials) for each state, row by row; the repaired lines travel along."""
    key = "COALESCE(CAST(conv_id AS VARCHAR), ' ') || ':' || COALESCE(CAST(turn AS VARCHAR), ' ')"
    none = "{'c': NULL::BIGINT, 'a': NULL::VARCHAR, 't': NULL::VARCHAR}"

    def go(state: str, cost: str, edits: str, lines: str, when: str) -> str:
        return (f"CASE WHEN {state}.c IS NOT NULL AND ({when}) THEN {{'c': {state}.c + {cost}, 'a': {state}.a || {edits}, "
                f"'t': {state}.t || {lines}}} ELSE {none} END")

    stay = "x.fault < 2"
    kept = "(x.role || ':' || x.text || chr(10))"

    def as_role(role: str) -> str:
        return f"('{role}:' || x.text || chr(10))"

    def arrivals(target: str, before: str, role: str, initial: str) -> list[str]:
        """Ways to ``target`` by a row in the state ``before``, kept or re-roled, with or without an insert ahead."""
        first = {"e": ("u", "user"), "s": ("u", "user"), "a": ("u", "user"), "u": ("a", "assistant")}
        out = []
        for state in "esua":
            went, said = first[state]
            for at, edit, price, line in ((state, "", 0, "''"), (went, "I", 2, f"('{said}:' || chr(10))")):
                if at in before:
                    out.append(go(f"p.{state}", f"{price} + x.fault", f"'{edit}K'", f"{line} || {kept}",
                                  f"{stay} AND x.initial = '{initial}'"))
                    if role:
                        out.append(go(f"p.{state}", f"{price} + 2 + x.fault", f"'{edit}R'", f"{line} || {as_role(role)}", stay))
        return out

    drop = {s: go(f"p.{s}", "3", "'D'", "''", "true") for s in "esua"}
    least = "list_sort(list_filter([{}], lambda z: z.c IS NOT NULL))[1]"
    step = {
        "e": [drop["e"]],
        "s": [drop["s"], go("p.e", "x.fault", "'K'", kept, f"{stay} AND x.initial = 's'")],
        "u": [drop["u"], *arrivals("u", "esa", "user", "u")],
        "a": [drop["a"], *arrivals("a", "u", "assistant", "a")],
    }
    states = ", ".join(f"COALESCE({least.format(', '.join(step[s]))}, {none}) AS {s}" for s in "esua")
    end = least.format(", ".join([
        "p.e", "p.a", go("p.u", "2", "'I'", "('assistant:' || chr(10))", "true"),
        go("p.s", "4", "'II'", "('user:' || chr(10) || 'assistant:' || chr(10))", "true")]))
    return rf"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text, {_crc32(key)} % 20 AS kind FROM conversations
),
hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM raw, (SELECT unnest([0, 1]) AS again) z WHERE kind <> 0 AND (again = 0 OR kind = 3)
),
lined AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM hurt
),
seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS nth FROM lined
),
x AS (
    SELECT conv_id, turn, role, text, k, substr(role, 1, 1) AS initial,
           CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 3 WHEN nth > 1 THEN 2
                WHEN regexp_matches(text, '[.!?][ 	-
]*$') THEN 0 ELSE 1 END AS fault
    FROM seen
),
run AS (
    SELECT conv_id, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS e, {none} AS s, {none} AS u, {none} AS a
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    UNION ALL
    SELECT p.conv_id, x.k, {states}
    FROM run p JOIN x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.k = p.k + 1
),
last AS (
    SELECT p.conv_id, {end} AS best FROM run p QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.k DESC) = 1
),
pairs AS (
    SELECT *, initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY k) AS pair FROM x
),
stats AS (
    SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
           COUNT(*) FILTER (fault = 3) AS blank, COUNT(*) FILTER (fault = 2) AS duplicate,
           COUNT(*) FILTER (fault = 1) AS truncated, COUNT(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM pairs GROUP BY conv_id
)
SELECT last.conv_id, COALESCE(gaps, 0) AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
       COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(CASE WHEN best.t = '' THEN '' ELSE substr(best.t, 1, length(best.t) - 1) END) AS repaired_sha256
FROM last LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM last.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_topk": TOP_K, "op12_merkle": _merkle(), "op13_conversations": _conversations(), "op6_embeddings": EMBEDDINGS, "op8_mixing": MIXING, "op10_decontamination": DECONTAMINATION}
