"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .fingerprints import LANES, MODULUS
from .mixing import MAX_REPEATS

_WORD = r"[^\x20\x09-\x0D]+"

MIXING = f"""
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
           md5(md5(coalesce(doc_id::VARCHAR, '')) || md5(coalesce(text, ''))) AS shuffle_key
    FROM documents
), ranked AS (
    SELECT source, sum(size) AS source_size, {MAX_REPEATS} * sum(size) AS cap,
           row_number() OVER (ORDER BY source NULLS LAST) AS source_rank,
           [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
    FROM sizes GROUP BY source
), leveled AS (
    SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(cap) OVER (
                  ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY cap / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              AS level
    FROM ranked
), water AS (
    SELECT arg_min(level, (cap / weight, source_rank)) AS water FROM leveled WHERE level * weight <= cap
), targets AS (
    SELECT source, source_rank, source_size, least(cap::DOUBLE, coalesce(weight * water, cap::DOUBLE)) AS target
    FROM leveled, water
), queued AS (
    SELECT s.*, t.source_rank, t.source_size, t.target,
           sum(size) OVER (PARTITION BY t.source_rank ORDER BY shuffle_key, doc_id NULLS FIRST, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sofar
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT *, (sofar + round * source_size) / target AS finish
    FROM queued, range({MAX_REPEATS}) AS r(round) WHERE size > 0
), running AS (
    SELECT *, sum(size) OVER (ORDER BY finish, shuffle_key, source_rank, doc_id NULLS FIRST, size, round
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM copies
), taken AS (
    SELECT doc_id, sum(size) AS taken FROM running
    WHERE upto <= (SELECT sum(size) FROM sizes) GROUP BY doc_id
)
SELECT q.doc_id, q.size::BIGINT AS size, q.source_size::BIGINT AS source_size, q.target,
       coalesce(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id
"""

_CONTROL = r"([<\[])(\||/?s>|/?INST\]|<?/?SYS>>)"

CHAT = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *, len(regexp_replace(replace(role, '\\', '\\\\'), '{_CONTROL}', '\\1\\\\\\2', 'g'))
              + len(regexp_replace(replace(text, '\\', '\\\\'), '{_CONTROL}', '\\1\\\\\\2', 'g'))
              + len('<|turn|>') + len('<|text|>') + len('<|end|>') + 1 AS chars
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def _fingerprints() -> str:
    def lane(k: int, bit: int) -> str:
        return f"sum((w{k} >> {bit}) & 1)"

    # In the operator's order: the low halves of all words, the high halves, the count.
    lanes = [lane(k, i) for k in range(LANES // 32) for i in range(16)]
    lanes += [lane(k, i + 16) for k in range(LANES // 32) for i in range(16)]
    words = ", ".join(f"('0x' || md5(piece)[{1 + 8 * k}:{8 + 8 * k}])::BIGINT AS w{k}" for k in range(LANES // 32))
    dot = "list_sum([({a}[i] * {b}[i])::DOUBLE for i in range(1, {n} + 1)])".format
    near = lambda a, b: (
        f"CASE WHEN f.lanes = {b}.lanes THEN 1.0 ELSE coalesce(greatest(0.0, least(1.0, "
        f"{dot(n=LANES, a='f.centered', b=b + '.centered')} / nullif(sqrt({dot(n=LANES, a='f.centered', b='f.centered')}"
        f" * {dot(n=LANES, a=b + '.centered', b=b + '.centered')}), 0))), 0.0) END"
    )
    text = f"array_to_string([lpad(lower(to_hex(x)), 6, '0') for x in {{}}.lanes], '')"
    return f"""
WITH docs AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, md5(coalesce(text, '')), coalesce(text, '')) AS place, doc_id,
           coalesce(text, '') AS text
    FROM documents
), led AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY place), first_value(text) OVER (ORDER BY place)) AS next_text,
           length(text) AS n_chars, (length(text) // 2) AS half
    FROM docs
), versions AS (
    SELECT place, 0 AS version, text FROM led
    UNION ALL
    SELECT place, 1, text[1:n_chars - half] || next_text[1:half] FROM led
), cut AS (
    SELECT place, version, trim(unnest(string_split(
        regexp_replace(regexp_replace(text, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(10), 'g'), '\\n', chr(10), 'g'), chr(10)))) AS piece
    FROM versions
), hashed AS (
    SELECT place, version, {words} FROM cut WHERE piece <> ''
), summed AS (
    SELECT v.place, v.version,
           [{", ".join(f"(coalesce({x}, 0) % {MODULUS})::BIGINT" for x in [*lanes, "count(w0)"])}] AS lanes
    FROM versions v LEFT JOIN hashed h ON v.place = h.place AND v.version = h.version
    GROUP BY v.place, v.version
), f AS (
    SELECT *, [2 * x - lanes[{LANES + 1}] for x in lanes[1:{LANES}]] AS centered FROM summed
)
SELECT l.doc_id, l.n_chars, sha256(v.text) AS edited_sha256,
       {text.format("f")} AS fingerprint, {text.format("e")} AS edited_fingerprint,
       {near("f", "e")} AS near_edited, {near("f", "n")} AS near_next
FROM led l
JOIN versions v ON v.place = l.place AND v.version = 1
JOIN f ON f.place = l.place AND f.version = 0
JOIN f e ON e.place = l.place AND e.version = 1
JOIN f n ON n.place = l.place % (SELECT count(*) FROM led) + 1 AND n.version = 0
"""


_FINITE = "embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0"


def _integers(factor: int) -> str:
    """Doubles that hold the integers: their products and sums stay exact."""
    return f"[floor({factor} * x::DOUBLE) for x in embedding] AS weights"


TOPK = f"""
WITH vectors AS (SELECT vec_id, {_integers(1024)} FROM embeddings WHERE {_FINITE}),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.weights, c.weights)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank",
           vec_id, score
    FROM scored
)
SELECT * FROM ranked WHERE "rank" <= 10
"""

HARD_NEGATIVES = f"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_integers(256)}
    FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_dot_product(a.weights, c.weights)::BIGINT AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS "rank",
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM negatives WHERE "rank" <= 10
"""

AUDIT = f"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words
    FROM documents
), rated AS (
    SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic
    FROM labels GROUP BY doc_id
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), failed AS (
    SELECT d.part, coalesce(r.good, 0) AS good, coalesce(r.toxic, 0) AS toxic,
           map {{
               'A': len(words) < 100,
               'B': 100 * len(list_distinct(words)) < 80 * len(words),
               'C': 100 * len(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 10 * len(d.text),
               'D': regexp_matches(d.text, '[#$%&*|]'),
               'E': coalesce(f.first_id < d.doc_id, false)
           }} AS fails
    FROM docs d JOIN firsts f ON d.text = f.text LEFT JOIN rated r ON d.doc_id = r.doc_id
), grouped AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS letter,
           string_split(filter_order[1:step - 1], '') AS before
    FROM orders, range(1, 6) AS t(step)
), placed AS (
    SELECT g.part, s.filter_order, s.step, s.letter, n, good, toxic, fails[s.letter] AS here,
           len([b for b in s.before if b <> '' AND fails[b]]) > 0 AS earlier,
           len([v for v in map_values(fails) if v]) = 1 AS single
    FROM grouped g, steps s
), summed AS (
    SELECT part, filter_order, step, letter,
           coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (here AND NOT earlier), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (here AND earlier), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (here AND single), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (here AND NOT earlier), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (here AND NOT earlier), 0)::BIGINT AS toxic_lost
    FROM placed GROUP BY part, filter_order, step, letter
)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM summed
"""

EXPECTED_SQL = {
    "op4_mixing": MIXING,
    "op6_chat": CHAT,
    "op7_fingerprints": _fingerprints(),
    "op11_topk": TOPK,
    "op12_audit": AUDIT,
    "op13_hard_negatives": HARD_NEGATIVES,
}
