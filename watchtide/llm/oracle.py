"""The results of the check queries in DuckDB SQL, for all that SQL can express."""

from __future__ import annotations

from watchtide.llm.secrets import ALLOW, ASSIGN, ENTROPY, NARROW

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
KEY = "('0x' || substr(md5(concat_ws('/', {})), 1, 13))::BIGINT"


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int, texts: str = "docs") -> str:
    """Spans of one kind in ``texts (doc_id, origin, text)``: pieces between matches and matches, added up."""
    p = _text(pattern)
    return f"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, origin + place AS start, origin + place + length(whole) AS stop, whole FROM (
        SELECT doc_id, origin, whole, part, (sum(length(gap) + coalesce(length(whole), 0)) OVER (PARTITION BY doc_id, origin ORDER BY i)
            - coalesce(length(whole), 0))::BIGINT AS place
        FROM (SELECT doc_id, origin, unnest(range(1, len(gaps) + 1)) AS i, unnest(gaps) AS gap, unnest(wholes) AS whole, unnest(parts) AS part
              FROM (SELECT doc_id, origin, regexp_split_to_array(text, {p}) AS gaps, list_resize(regexp_extract_all(text, {p}), len(gaps), NULL) AS wholes,
                        list_resize(regexp_extract_all(text, {p}, {group}), len(gaps), NULL) AS parts FROM {texts}))
    ) WHERE whole IS NOT NULL AND length(part) >= {least}"""


#: The allow-list as one pattern. The engine here needs no possessive groups.
_ALLOWED = _text("|".join(f"(?:{a})" for a in ALLOW).replace("}+", "}"))
_MUST = {
    "entropy_hex": ["[0-9][A-F]|[A-F][0-9]"],
    "entropy_base64": ["[a-z]", "[A-Z]", "[0-9]"],
    "entropy_base36": ["[a-z]", "[0-9]"],
    "entropy_base32": ["[A-Z]", "[0-9]"],
    "entropy_letters": ["[a-z]", "[A-Z]"],
    "entropy_lower": ["[a-z]"],
    "entropy_upper": ["[A-Z]"],
}


def _entropy_sql(rank: int, c) -> str:
    must = " AND ".join(f"regexp_matches(whole, {_text(m)})" for m in _MUST[c.kind])
    return f"""
    SELECT s.* FROM ({_spans_sql(c.kind, rank, f"[{c.characters}]{{{c.width},}}", 0, c.width, "pieces")}) s
    WHERE {must} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b.start <= s.start AND b.stop >= s.stop)
        AND list_max(list_transform(range(1, length(whole) - {c.width} + 2), lambda i: list_entropy(string_split(substr(whole, i, {c.width}), '')))) >= {c.bits}"""


_BASE = [("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
_CLASSES = list(enumerate(ENTROPY + NARROW, len(_BASE)))
OP1 = f"""
WITH docs AS (SELECT doc_id, 0 AS origin, coalesce(text, '') AS text FROM documents),
base AS ({" UNION ALL ".join(_spans_sql(k, r, p, g, n) for r, (k, p, g, n) in enumerate(_BASE))}),
runs AS ({_spans_sql("run", 0, "[A-Za-z0-9+/_-]{16,}", 0, 0)}),
parts AS (SELECT doc_id, start, unnest(range(1, len(gaps) + 1)) AS i, unnest(gaps) AS gap, unnest(cuts) AS cut FROM (
    SELECT doc_id, start, regexp_split_to_array(whole, {_ALLOWED}) AS gaps, list_resize(regexp_extract_all(whole, {_ALLOWED}), len(gaps), NULL) AS cuts FROM runs)),
pieces AS (SELECT doc_id, (start + sum(length(gap) + coalesce(length(cut), 0)) OVER (PARTITION BY doc_id, start ORDER BY i)
    - length(gap) - coalesce(length(cut), 0))::BIGINT AS origin, gap AS text FROM parts WHERE gap <> '' OR cut <> ''),
extra AS ({" UNION ALL ".join(_entropy_sql(r, c) for r, c in _CLASSES)}),
spans AS (SELECT * FROM base UNION ALL
    SELECT * FROM extra e WHERE kind NOT IN ({", ".join(_text(c.kind) for c in NARROW)}) OR NOT EXISTS (SELECT 1 FROM extra k WHERE k.doc_id = e.doc_id AND k.start <= e.start AND k.stop >= e.stop
        AND (length(k.whole) > length(e.whole) OR k.rank < e.rank)))
SELECT d.doc_id, coalesce(count_if(kind = 'assign'), 0)::BIGINT AS n_assign, coalesce(count_if(kind = 'access'), 0)::BIGINT AS n_access, coalesce(count_if(kind = 'hex'), 0)::BIGINT AS n_hex,
    sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < {len(_BASE)}), '')) AS base_sha256,
    coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank), '') AS spans
FROM docs d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id
"""

OP3 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
    SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""


#: Topology of the query: 2 regions of 2 racks of 4 shards, and a region of its own for the shard added.
_U = "-ln((" + KEY.format("coalesce(doc_id::VARCHAR, ''), {path}") + "::DOUBLE + 0.5) / 4503599627370496.0)"


def _draw_sql(children: str) -> str:
    """The child with the least draw, from a list of (path, weight)."""
    return f"list_sort(list_transform({children}, lambda c: {{'at': {_U.format(path='c.path')} / c.weight, 'path': c.path}}))[1].path"


OP4 = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
given AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, xor(list_reduce(list_concat([4294967295::BIGINT],
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32 FROM documents, crc),
a AS (SELECT *, {_draw_sql("[{'path': 'r0', 'weight': 8.0}, {'path': 'r1', 'weight': 8.0}]")} AS region,
    {_draw_sql("[{'path': 'r+16', 'weight': 1.0}, {'path': 'r0', 'weight': 8.0}, {'path': 'r1', 'weight': 8.0}]")} AS grown_region FROM given),
b AS (SELECT *, {_draw_sql("[{'path': region || '/k0', 'weight': 4.0}, {'path': region || '/k1', 'weight': 4.0}]")} AS rack FROM a),
c AS (SELECT *, string_split({_draw_sql("list_transform(range(4), lambda i: {'path': rack || '/' || (CASE WHEN rack[2] = '1' THEN 8 ELSE 0 END + CASE WHEN rack[-1] = '1' THEN 4 ELSE 0 END + i), 'weight': 1.0})")}, '/')[-1]::INT AS shard FROM b)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY {KEY.format("coalesce(doc_id::VARCHAR, '')")}, doc_id, size, text_crc32) - 1 AS slot,
    CASE WHEN grown_region = 'r+16' THEN 16 ELSE shard END AS grown_shard
FROM c
"""

OP6 = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM split),
keyed AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
owned AS (SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS lost FROM keyed)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(lost)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM owned GROUP BY doc_id
"""

OP7 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h, max(page_id) OVER (PARTITION BY sha1(payload)) AS first FROM p),
b AS (SELECT *, array_to_string(list_transform(string_split(h, ''), lambda x: substr(bin(('0x' || x)::BIGINT + 16), 2, 4)), '') AS bits FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (1 + list_sum(list_transform(range(5), lambda j: CASE WHEN substr(bits, 5 * i + j + 1, 1) = '1' THEN 1 << (4 - j) ELSE 0 END)))::BIGINT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

OP8 = r"""
WITH sized AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
        ('0x' || substr(md5(concat_ws('/', coalesce(doc_id::VARCHAR, ''), 'mix')), 1, 13))::BIGINT AS key FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS most FROM sums),
levels AS (SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(most) OVER filled, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0.0)) AS level
    FROM weighed WINDOW filled AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
plan AS (SELECT source, source_size, least(most, max(level) OVER () * weight) AS target FROM levels),
placed AS (SELECT s.*, source_size, target, round(target)::BIGINT AS budget,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size + greatest(least(budget % source_size - before, size), 0) END::BIGINT AS taken
FROM placed
"""

OP9 = r"""
WITH parts AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM parts q JOIN parts c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 10
"""


def _strength_sql(table: str) -> str:
    """How much the prior of a level weighs: 1000 at most, 2 at least."""
    return f"""(SELECT CASE WHEN k < 2 OR bad = 0 OR bad = n OR alike <= 1 / 1001.0::DOUBLE THEN 1000.0::DOUBLE ELSE greatest(2.0::DOUBLE, (1 - alike) / alike) END FROM (
    SELECT *, CASE WHEN room > 0 THEN spread / room ELSE 0 END AS alike FROM (
    SELECT *, (bb - mean * bad) / (mean * (1 - mean)) - (k - 1) AS spread, n - nn / n - (k - 1) AS room FROM (
    SELECT *, bad / n AS mean FROM (
    SELECT count(*)::DOUBLE AS k, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(n::DOUBLE * n) AS nn, sum(bad::DOUBLE * bad / n) AS bb FROM {table} WHERE n > 0)))))"""


_TWO = "len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')"
_RULES = [("allow", "www.example.com", "/en/"), ("block", "example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "com", "/")]
_FITS = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in _RULES]
OP10 = f"""
WITH urls AS (SELECT page_id, {LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS (SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
counts AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(host, '.') AS l FROM urls LEFT JOIN judged USING (page_id) GROUP BY host),
hosts AS (SELECT host, n, bad, array_to_string(l[-(CASE WHEN {_TWO} THEN 3 ELSE 2 END):], '.') AS domain,
    array_to_string(l[-(CASE WHEN {_TWO} THEN 2 ELSE 1 END):], '.') AS suffix FROM counts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
strengths AS (SELECT {_strength_sql("suffixes")} AS s, {_strength_sql("domains")} AS d, {_strength_sql("hosts")} AS h,
    (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) FROM hosts) AS whole),
by_domain AS (SELECT d.*, (p.bad - d.bad + t.whole * t.s) / (p.n - d.n + t.s) AS m FROM domains d JOIN suffixes p USING (suffix), strengths t),
by_host AS (SELECT x.host, x.n, t.h, (x.bad + (p.bad - x.bad + p.m * t.d) / (p.n - x.n + t.d) * t.h) / (x.n + t.h) AS m
    FROM hosts x JOIN by_domain p USING (domain, suffix), strengths t)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {fit} THEN '{h + p}'" for fit, (_, h, p) in zip(_FITS, _RULES))} END AS rule,
    CASE {" ".join(f"WHEN {fit} THEN '{v}'" for fit, (v, _, _) in zip(_FITS, _RULES))}
        WHEN m - 2.0::DOUBLE * sqrt(m * (1 - m) / (n + h + 1)) > 0.2 THEN 'block' ELSE 'allow' END AS verdict
FROM urls JOIN by_host USING (host)
"""

#: The unsigned CRC-32 of text ``x``, byte by byte from a table of 256 remainders ``t``.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(regexp_extract_all(hex(encode({x})), '..'),
        lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""

#: Words ``period`` apart are joined on being equal; neighbours of one period make a stretch, the least period of a stretch is its own.
OP12 = rf"""
WITH crc AS {_CRC_TABLE},
split AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    {_CRC.format(x="doc_id::VARCHAR")} AS h FROM documents, crc),
sized AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM split),
cut AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM sized),
unit AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
docs AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM unit),
words AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM docs),
pairs AS (SELECT x.doc_id, y.i - x.i AS period, x.i FROM words x JOIN words y USING (doc_id, word) WHERE y.i > x.i AND y.i - x.i <= x.n // 3),
stretches AS (SELECT doc_id, period, i, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS stretch FROM pairs),
long AS (SELECT doc_id, period, min(i) AS start, count(*) + period AS length FROM stretches GROUP BY doc_id, period, stretch HAVING count(*) + period >= greatest(24, 3 * period)),
runs AS (SELECT doc_id, start, length, min(period) AS period FROM long GROUP BY doc_id, start, length),
lost AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    list(struct_pack(s := start, l := length, p := period) ORDER BY start, period) AS r FROM runs GROUP BY doc_id),
best AS (SELECT *, list_reduce(r, lambda b, x: CASE WHEN x.l * b.p > b.l * x.p THEN x ELSE b END) AS b FROM found)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.p::BIGINT AS period, (1000 * b.l // b.p)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN best USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP13 = rf"""
WITH crc AS {_CRC_TABLE},
texts AS (SELECT 0 AS side, row_number() OVER () AS doc, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
split AS (SELECT side, doc, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
listed AS (SELECT *, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM split),
features AS (SELECT side, doc, unnest(f) AS f FROM listed),
counted AS (SELECT side, doc, f, count(*) AS n FROM features GROUP BY ALL),
hashed AS (SELECT f, {_CRC.format(x="f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM counted), crc),
placed AS (SELECT side, doc, bucket, sum(n) AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
buckets AS (SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t FROM placed GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM buckets) + 10000) / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000))))::BIGINT AS gain FROM buckets),
sums AS (SELECT doc, sum(n * gain)::BIGINT AS gain FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc),
weighed AS (SELECT doc_id, len(w) AS n_words, len(f)::BIGINT AS n_features, CASE WHEN len(f) = 0 THEN 0 ELSE (gain - ((gain % len(f)) + len(f)) % len(f)) // len(f) END::BIGINT AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM listed LEFT JOIN sums USING (doc) WHERE side = 0),
scored AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score FROM weighed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END::BIGINT AS rank FROM ranked
"""

ORACLE = {
    "op1_secret_scan": OP1,
    "op3_near_duplicates": OP3,
    "op4_sharding": OP4,
    "op6_line_dedup": OP6,
    "op7_warc": OP7,
    "op8_mixing": OP8,
    "op9_exact_top_k": OP9,
    "op10_url_filter": OP10,
    "op12_periodic_runs": OP12,
    "op13_resampling": OP13,
}
