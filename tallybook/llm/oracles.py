"""The results of the registered queries as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

from tallybook.llm.quality import BOILERPLATE, MIN_WORDS, SHORT_WORDS, UNENDED_WORDS

WORD = r"[^\x20\x09-\x0D]+"

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), lines AS (
    SELECT row, doc_id, generate_subscripts(l, 1) AS part, unnest(l) AS line
    FROM (SELECT row, doc_id, string_split(text, chr(10)) AS l FROM docs)
), worded AS (
    SELECT row, doc_id, part, regexp_extract_all({_LOWER.format("line")}, '{WORD}') AS w FROM lines
), shingled AS (
    SELECT row, doc_id, part, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
        list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])) END AS s
    FROM worded WHERE len(w) > 0
), sets AS (
    SELECT row_number() OVER () AS id, s, min((doc_id, part)) AS first FROM shingled GROUP BY s
), single AS (
    SELECT id, len(s) AS n, unnest(s) AS token FROM sets
), pairs AS (
    SELECT a.id AS a, b.id AS b FROM single a JOIN single b USING (token) WHERE a.id <> b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), earliest AS (
    SELECT x.id, least(x.first, min(y.first)) AS first
    FROM sets x LEFT JOIN pairs ON x.id = a LEFT JOIN sets y ON y.id = b GROUP BY x.id, x.first
), gone AS (
    SELECT row, part FROM shingled JOIN sets USING (s) JOIN earliest e USING (id) WHERE (doc_id, part) <> e.first
), kept AS (
    SELECT row, string_agg(line, chr(10) ORDER BY part) AS text
    FROM lines ANTI JOIN gone USING (row, part) GROUP BY row
)
SELECT doc_id, length(coalesce(k.text, '')) AS kept_chars, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept k USING (row)
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{WORD}') AS w
    FROM documents
), shingled AS (
    SELECT row, doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
        list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])) END AS s
    FROM docs WHERE len(w) > 0
), sets AS (
    SELECT row_number() OVER () AS id, s, min(doc_id) AS least, count(*) AS copies FROM shingled GROUP BY s
), single AS (
    SELECT id, len(s) AS n, unnest(s) AS token FROM sets
), pairs AS (
    SELECT a.id AS a, b.id AS b FROM single a JOIN single b USING (token) WHERE a.id <> b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
    SELECT id AS a, id AS b FROM sets UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b
), named AS (
    SELECT a AS id, min(y.least) AS component_id FROM reach JOIN sets y ON y.id = b GROUP BY a
), linked AS (
    SELECT a AS id, sum(y.copies) AS n FROM pairs JOIN sets y ON y.id = b GROUP BY a
)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles,
    CASE WHEN s.s IS NULL THEN d.doc_id ELSE component_id END AS component_id,
    coalesce(l.n + x.copies - 1, x.copies - 1, 0)::BIGINT AS n_links
FROM docs d LEFT JOIN shingled s USING (row) LEFT JOIN sets x ON x.s = s.s
    LEFT JOIN named USING (id) LEFT JOIN linked l USING (id)
"""

CHAT_FORMATTING = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER w AS place,
        lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
    SELECT *, length(regexp_replace(text, '(<s>|</s>|\[/?INST\]|\[OUT\]|\[ROLE\]|\[SAYS\]|\[END\]|\[NEXT\])', 'x\1', 'g'))
        + CASE WHEN NOT opens THEN 8 WHEN role = 'user' THEN 7 WHEN role = 'assistant' THEN 6 ELSE 15 + length(role) END
        + CASE WHEN NOT closes THEN 0 WHEN role = 'user' THEN 8 WHEN role = 'assistant' THEN 5 ELSE 6 END AS chars
    FROM placed
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_PHRASES = ", ".join(f"{{'p': '{p}', 'n': {len(p.split())}}}" for p in BOILERPLATE)

QUALITY_RULES = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT row, generate_subscripts(w, 1) AS i, unnest(w) AS word
    FROM (SELECT row, regexp_extract_all(text, '{WORD}') AS w FROM docs)
), grams AS (
    SELECT row, i, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS gram
    FROM words WINDOW w AS (PARTITION BY row ORDER BY i)
), twice AS (
    SELECT row, i FROM grams WHERE gram IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, gram) > 1
), repeated AS (
    SELECT row, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY row
), lines AS (
    SELECT row, unnest(string_split(text, chr(10))) AS line FROM docs
), told AS (
    SELECT row, line, regexp_extract_all(line, '{WORD}') AS w FROM lines WHERE regexp_matches(line, '{WORD}')
), phrased AS (
    SELECT *, list_sum(list_transform([{_PHRASES}], lambda f: f.n * list_transform(
        [string_split({_LOWER.format("line")}, f.p)], lambda x: len(list_filter(range(1, len(x)), lambda i:
            NOT regexp_matches(right(CASE WHEN i = 1 OR x[i] <> '' THEN x[i] ELSE f.p END, 1), '[\p{{L}}\p{{N}}]')
            AND (f.p[-1] = ' ' OR NOT regexp_matches(
                left(CASE WHEN i = len(x) - 1 OR x[i + 1] <> '' THEN x[i + 1] ELSE f.p END, 1), '[\p{{L}}\p{{N}}]'))
        )))[1])) AS phrases
    FROM told
), judged AS (
    SELECT row, line, len(w) AS n,
        5 * len(list_filter(w, lambda x: regexp_full_match(x, '[|>/\\]+'))) >= len(w)
        OR 10 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > length(array_to_string(w, ''))
        OR 3 * len(list_filter(w, lambda x: ends_with(x, '!!'))) > len(w)
        OR (NOT regexp_matches(w[-1], '[.!?:;"'')\]]$') AND len(w) < {UNENDED_WORDS})
        OR phrases > 0 AND (len(w) <= {SHORT_WORDS} OR 10 * phrases >= len(w)) AS failed
    FROM phrased
), by_row AS (
    SELECT row, sum(n) AS n_words, count(*) - count(DISTINCT line) AS n_dup_lines,
        coalesce(sum(n) FILTER (NOT failed), 0) AS n_words_left, count(*) FILTER (failed) AS n_lines_removed
    FROM judged GROUP BY row
), counted AS (
    SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words,
        length(array_to_string(regexp_extract_all(text, '{WORD}'), '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        coalesce(n_words_left, 0)::BIGINT AS n_words_left, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed
    FROM docs LEFT JOIN by_row USING (row) LEFT JOIN repeated r USING (row)
)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_words_left >= n_words AS kept
FROM counted
"""

_M = "18446744073709551616::UHUGEINT"
_P1, _P2, _P3, _P4, _P5 = (
    f"{p}::UHUGEINT"
    for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)  # fixed values of the XXH64 hash


def _rotate(x: str, by: int) -> str:
    return f"((({x}) * {1 << by}::UHUGEINT) % {_M} + (({x}) >> {64 - by}))"


def _mix(acc: str, word: str) -> str:
    return f"(({_rotate(f'({acc} + {word} * {_P2}) % {_M}', 31)} * {_P1}) % {_M})"


def _lane(start: str, k: int) -> str:
    words = f"list_transform(range(n // 32), lambda s: words[4 * s + {k + 1}])"
    return f"list_reduce([{start}] || {words}, lambda a, x: {_mix('a', 'x')})"


def _merged(h: str, lane: str) -> str:
    return f"(xor({h}, {_mix('0::UHUGEINT', lane)}) * {_P1} + {_P4}) % {_M}"


SIMHASH = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{WORD}') AS w
    FROM documents
), shingled AS (
    SELECT row, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END) AS gram
    FROM docs WHERE len(w) > 0
), counted AS (
    SELECT row, gram, count(*) AS times FROM shingled GROUP BY row, gram
), bytes AS (
    SELECT gram, n, list_transform(range(n), lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::UBIGINT::UHUGEINT) AS b
    FROM (SELECT gram, strlen(gram) AS n, hex(encode(gram)) AS hx FROM (SELECT DISTINCT gram FROM counted))
), worded AS (
    SELECT gram, n, b, list_transform(range(n // 8), lambda k:
        {" + ".join(f"b[8 * k + {j + 1}] * {256**j}::UHUGEINT" for j in range(8))}) AS words FROM bytes
), lanes AS (
    SELECT gram, n, b, words, {_lane(f"(42 + {_P1} + {_P2}) % {_M}", 0)} AS v1, {_lane(f"(42 + {_P2}) % {_M}", 1)} AS v2,
        {_lane("42::UHUGEINT", 2)} AS v3, {_lane(f"(42 + {_M} - {_P1}) % {_M}", 3)} AS v4
    FROM worded
), merged1 AS (
    SELECT *, ({_rotate("v1", 1)} + {_rotate("v2", 7)} + {_rotate("v3", 12)} + {_rotate("v4", 18)}) % {_M} AS h FROM lanes
), merged2 AS (
    SELECT * REPLACE ({_merged("h", "v1")} AS h) FROM merged1
), merged3 AS (
    SELECT * REPLACE ({_merged("h", "v2")} AS h) FROM merged2
), merged4 AS (
    SELECT * REPLACE ({_merged("h", "v3")} AS h) FROM merged3
), merged5 AS (
    SELECT * REPLACE ({_merged("h", "v4")} AS h) FROM merged4
), sized AS (
    SELECT gram, n, b, words, ((CASE WHEN n >= 32 THEN h ELSE (42 + {_P5}) % {_M} END) + n::UHUGEINT) % {_M} AS h
    FROM merged5
), by_word AS (
    SELECT gram, n, b, list_reduce([h] || words[4 * (n // 32) + 1:], lambda a, x:
        ({_rotate(f"xor(a, {_mix('0::UHUGEINT', 'x')})", 27)} * {_P1} + {_P4}) % {_M}) AS h FROM sized
), by_half AS (
    SELECT gram, n, b, CASE WHEN n % 8 >= 4 THEN list_reduce([h, b[n // 8 * 8 + 1] + b[n // 8 * 8 + 2] * 256
        + b[n // 8 * 8 + 3] * 65536 + b[n // 8 * 8 + 4] * 16777216], lambda a, x:
        ({_rotate(f"xor(a, (x * {_P1}) % {_M})", 23)} * {_P2} + {_P3}) % {_M}) ELSE h END AS h FROM by_word
), by_byte AS (
    SELECT gram, list_reduce([h] || b[n // 4 * 4 + 1:], lambda a, x:
        ({_rotate(f"xor(a, (x * {_P5}) % {_M})", 11)} * {_P1}) % {_M}) AS h FROM by_half
), hashed AS (
    SELECT gram, xor(h, h >> 32) AS h FROM (SELECT gram, (xor(h, h >> 29) * {_P3}) % {_M} AS h
        FROM (SELECT gram, (xor(h, h >> 33) * {_P2}) % {_M} AS h FROM by_byte))
), votes AS (
    SELECT row, bit, sum(times) AS n, sum(times * ((h::UBIGINT >> bit) & 1)) AS ones
    FROM counted JOIN hashed USING (gram), range(64) r(bit) GROUP BY row, bit
), printed AS (
    SELECT row, bit_or(CASE WHEN 2 * ones > n THEN 1::UBIGINT << bit::UBIGINT ELSE 0::UBIGINT END) AS f
    FROM votes GROUP BY row
), prints AS (
    SELECT doc_id, coalesce(f, 0::UBIGINT) AS f FROM docs LEFT JOIN printed USING (row)
), nodes AS (
    SELECT f, min(doc_id) AS least FROM prints GROUP BY f
), pairs AS (
    SELECT a.f AS a, b.f AS b FROM nodes a, nodes b WHERE a.f <> b.f AND bit_count(xor(a.f, b.f)::UBIGINT) <= 3
), reach AS (
    SELECT f AS a, f AS b FROM nodes UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b
), named AS (
    SELECT a AS f, min(least) AS component_id FROM reach JOIN nodes ON b = f GROUP BY a
)
SELECT doc_id, lower(lpad(to_hex(f), 16, '0')) AS fingerprint, component_id FROM prints JOIN named USING (f)
"""

#: Levels of runs of 16 that the SQL states: enough for 16 million rows of a source, and as many sources.
_LEVELS = 6


def _plain(name: str, tampered: bool = False) -> str:
    text = _LOWER.format("text") if tampered and name == "text" else f"{name}::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(tampered: bool) -> str:
    fields = " || ".join(_plain(c, tampered) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    return f"sha256({fields})"


_CRC = """list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT),
        lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
            lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))"""


def _tree(name: str) -> str:
    """Levels of the trees ``{name}0 (tree, i, h)``: all nodes, those above, and so on."""
    steps = [
        f"""{name}{k + 1} AS MATERIALIZED (
    SELECT tree, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) WHERE n > 1 GROUP BY tree, i // 16
    UNION ALL SELECT tree, i, h FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) WHERE n = 1
)"""
        for k in range(_LEVELS)
    ]
    return ", ".join(steps)


def _climb(rows: str, name: str, out: str) -> str:
    """From ``{rows} (id, tree, i, proof, own)`` up the trees: the siblings met, and the digest folded from ``own``."""
    steps, last = [], rows
    for k in range(_LEVELS):
        steps.append(f"""{out}{k + 1} AS MATERIALIZED (
    SELECT c.id, c.tree, CASE WHEN count(*) > 1 OR any_value(n) > 1 THEN c.i // 16 ELSE c.i END AS i,
        c.proof || coalesce(string_agg(t.h, '' ORDER BY t.i) FILTER (t.i <> c.i), '') AS proof,
        CASE WHEN any_value(n) = 1 THEN c.own
            ELSE sha256(string_agg(CASE WHEN t.i = c.i THEN c.own ELSE t.h END, '' ORDER BY t.i)) END AS own
    FROM {last} c JOIN (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) t
        ON t.tree = c.tree AND t.i // 16 = c.i // 16
    GROUP BY c.id, c.tree, c.i, c.proof, c.own
)""")
        last = f"{out}{k + 1}"
    return ", ".join(steps)


MERKLE_MANIFEST = f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, source, {_leaf(False)} AS leaf,
        CASE WHEN xor({_CRC}, 4294967295::UBIGINT) % 5 = 0 THEN {_leaf(True)} ELSE {_leaf(False)} END AS own
    FROM documents
), placed AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id, doc_id, leaf, own,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
    FROM leaves
), s0 AS MATERIALIZED (
    SELECT tree, i, leaf AS h FROM placed
), {_tree("s")}, r0 AS MATERIALIZED (
    SELECT 0 AS tree, tree AS i, h FROM s{_LEVELS}
), {_tree("r")}, c0 AS MATERIALIZED (
    SELECT id, tree, i, '' AS proof, own FROM placed
), {_climb("c0", "s", "c")}, d0 AS MATERIALIZED (
    SELECT id, 0 AS tree, tree AS i, proof, own FROM c{_LEVELS}
), {_climb("d0", "r", "d")}
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.own AS folded_root,
    d.own = r.h AS verified
FROM placed p JOIN d{_LEVELS} d USING (id) JOIN s{_LEVELS} s ON s.tree = p.tree, r{_LEVELS} r
"""


def _rounds(n: int) -> str:
    steps = []
    for k in range(n + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT row, min_by(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT x.row, y.c, sum((x.v - y.v) * (x.v - y.v))::BIGINT AS d FROM parts x JOIN c{k} y USING (j) GROUP BY x.row, y.c
    ) GROUP BY row
)""")
        if k < n:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
    SELECT y.c, y.j, coalesce(m.v, y.v) AS v FROM c{k} y LEFT JOIN (
        SELECT c, j, (s - (s % n + n) % n) // n AS v
        FROM (SELECT a.c, x.j, sum(x.v) AS s, count(*) AS n FROM parts x JOIN a{k} a USING (row) GROUP BY a.c, x.j)
    ) m USING (c, j)
)""")
    return ", ".join(steps)


CENTROID_CLUSTERS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), parts AS MATERIALIZED (
    SELECT row, unnest(range(64)) AS j, unnest(v) AS v FROM kept
), c0 AS MATERIALIZED (
    SELECT c, unnest(range(64)) AS j, unnest(v)::HUGEINT AS v FROM (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < 8)
), {_rounds(10)}, digests AS (
    SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY j)) AS digest FROM c10 GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, digest AS centroid_sha256
FROM kept JOIN a10 USING (row) JOIN digests USING (c)
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op3_chat_formatting": CHAT_FORMATTING,
    "op9_quality_rules": QUALITY_RULES,
    "op11_simhash": SIMHASH,
    "op12_merkle_manifest": MERKLE_MANIFEST,
    "op13_centroid_clusters": CENTROID_CLUSTERS,
}
