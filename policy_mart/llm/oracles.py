"""DuckDB SQL that gives the rows of the queries that SQL can express.

The trained, signature-based and graph-based operators (1, 6, 8, 10 and the pipeline) and the token files
(11) have none; tests compare them with brute force.
"""

from __future__ import annotations

from .lines import FIELD
from .secrets import ALLOWED, ASSIGN_LEAST, CLASSES, WHOLE
from .shards import _HEX

ORACLES: dict[str, str] = {}


def _spans(kind: int, pattern: str, keep: str = "TRUE") -> str:
    """Rows (doc_id, first, kind, until, hit) of a pattern's matches: the pieces between matches add up to positions."""
    p = pattern.replace("'", "''")
    return f"""(
  WITH m AS (SELECT doc_id, string_split_regex(t, '{p}') AS pieces, regexp_extract_all(t, '{p}') AS hits FROM docs),
  u AS (SELECT doc_id, generate_subscripts(hits, 1) AS i, unnest(hits) AS hit, pieces FROM m),
  l AS (SELECT doc_id, i, hit, length(pieces[i]) AS gap FROM u)
  SELECT doc_id, CAST(sum(gap + length(hit)) OVER w - length(hit) AS BIGINT) AS first, {kind} AS kind,
    CAST(sum(gap + length(hit)) OVER w AS BIGINT) AS until, hit
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i) QUALIFY {keep})"""


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _entropy(cls) -> str:
    """The largest entropy of a window of a hit, from the counts of its characters."""
    w = cls.window
    window = f"substr(hit, s.s, {w})"
    chars = f"list_distinct(string_split({window}, ''))"
    share = f"(length({window}) - length(replace({window}, c, ''))) / {w}.0"
    return (
        f"(SELECT max(list_sum(list_transform({chars}, lambda c: -{share} * log2({share})))) "
        f"FROM range(1, length(hit) - {w - 2}) s(s))"
    )


def _random(kind: int, cls) -> str:
    needs = " AND ".join(f"regexp_matches(hit, '{n}')" for n in cls.needs)
    rows = _spans(kind, f"[{cls.chars}]{{{cls.least},}}", needs)
    return f"SELECT * FROM {rows} WHERE {_entropy(cls)} >= {cls.bits}"


_allowed = " OR ".join(f"regexp_matches(hit, '{a}')" for a in ALLOWED)
_covers = "EXISTS (SELECT 1 FROM {0} o WHERE o.doc_id = s.doc_id AND o.first <= s.first AND s.until <= o.until{1})"
_names = ["assign", "access", "hex", *[c.name for c in CLASSES]]
_label = "CASE kind " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_names)) + " END"
_joined = f"string_agg({_label} || ':' || first || ':' || until, ',' ORDER BY first, kind)"

ORACLES["op2_secrets"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT * FROM {_spans(0, _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN.replace("'", "''")}', 2)) >= {ASSIGN_LEAST}")}
  UNION ALL SELECT * FROM {_spans(1, "AKIA[A-Z0-9]+", "length(hit) >= 20")}
  UNION ALL SELECT * FROM {_spans(2, "[0-9a-f]+", "length(hit) >= 24")}),
random AS ({" UNION ALL ".join(_random(k, c) for k, c in enumerate(CLASSES, start=3))}),
allowed AS (SELECT * FROM {_spans(0, WHOLE, _allowed)}),
fresh AS (SELECT * FROM random s WHERE NOT {_covers.format("allowed", "")} AND NOT {_covers.format("base", "")}
  AND NOT {_covers.format("random", " AND o.kind < s.kind")}),
both_kinds AS (SELECT * FROM base UNION ALL SELECT * FROM fresh),
b AS (SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h, {_joined} AS s FROM base GROUP BY doc_id),
a AS (SELECT doc_id, {_joined} AS s FROM both_kinds GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.a, 0) AS n_assign, coalesce(b.k, 0) AS n_access, coalesce(b.h, 0) AS n_hex,
  sha256(coalesce(b.s, '')) AS base_sha256, coalesce(a.s, '') AS spans
FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)
"""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES["op3_mixture"] = f"""
WITH d AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, source_size * 3.0::DOUBLE AS cap FROM s),
x AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS w_all,
  coalesce(sum(cap) OVER e, 0) AS c_before, coalesce(sum(w) OVER e, 0) AS w_before
  FROM w WINDOW e AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * (w_all - w_before) <= w * (total - c_before) AS is_full FROM x),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * (total - coalesce(sum(cap) FILTER (is_full) OVER (), 0))
  / (w_all - coalesce(sum(w) FILTER (is_full) OVER (), 0)) END AS target FROM f),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY size, digest) - 1 AS rank FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (SELECT *, CAST('0x' || substr(md5('0:' || CASE WHEN source IS NULL THEN '1' ELSE '0' || source END), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS start FROM r),
c AS (SELECT *, CAST(floor((rank + 1) * rate + start) - floor(rank * rate + start) AS BIGINT) AS copies FROM o)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM c
"""

ORACLES["op4_line_templates"] = f"""
WITH texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
split_lines AS (SELECT text, generate_subscripts(ls, 1) - 1 AS i, unnest(ls) AS line FROM (SELECT text, string_split(text, chr(10)) AS ls FROM texts)),
lines AS (SELECT text, i, line, list_filter(string_split(regexp_replace(line, '[^ ]*[0-9][^ ]*', '{FIELD}', 'g'), ' '), lambda x: x <> '') AS toks FROM split_lines),
l AS (SELECT *, len(toks) AS n, len(toks) || ':' || array_to_string(toks[1:3], ' ') AS leaf FROM lines WHERE len(toks) > 0),
leaves AS (SELECT leaf FROM l GROUP BY leaf HAVING count(DISTINCT text) >= 5),
k AS (SELECT l.* FROM l SEMI JOIN leaves USING (leaf)),
p AS (SELECT text, i, leaf, generate_subscripts(toks[4:], 1) AS pos, unnest(toks[4:]) AS tok FROM k),
fixed AS (SELECT leaf, pos, tok FROM p GROUP BY ALL HAVING count(*) >= 5),
shape AS (SELECT text, i, count(*) AS fixed, string_agg(pos || '=' || tok, ' ' ORDER BY pos) AS shape FROM p SEMI JOIN fixed USING (leaf, pos, tok) GROUP BY text, i),
t AS (SELECT k.text, k.i, k.n, leaf || '|' || coalesce(shape, '') AS template FROM k LEFT JOIN shape ON k.text = shape.text AND k.i = shape.i
  WHERE coalesce(fixed, 0) >= 0.75 * greatest(k.n - 3, 0)),
again AS (SELECT template FROM t GROUP BY template HAVING count(DISTINCT text) >= 5),
gone AS (SELECT text, i, n FROM t SEMI JOIN again USING (template)),
docs AS (SELECT l.text, sum(l.n) AS words, coalesce(sum(gone.n), 0) AS lost, list(gone.i ORDER BY gone.i) FILTER (gone.i IS NOT NULL) AS numbers
  FROM l LEFT JOIN gone ON l.text = gone.text AND l.i = gone.i GROUP BY l.text),
r AS (SELECT d.doc_id, d.text, string_split(d.text, chr(10)) AS ls, coalesce(lost > 0.5 * words, FALSE) AS is_copy,
  CASE WHEN lost <= 0.5 * words THEN coalesce(numbers, []) ELSE [] END AS dropped FROM documents d LEFT JOIN docs ON d.text = docs.text)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS INTEGER) AS n_lines, coalesce(list_transform(dropped, lambda x: CAST(x AS INTEGER)), []) AS dropped, is_copy,
  array_to_string(list_filter(ls, lambda x, j: NOT list_contains(dropped, j - 1)), chr(10)) AS text FROM r
"""

_S, _V = 40, 64
_pos = "CAST('0x' || substr({0}, 1, %d) AS BIGINT)" % _HEX

ORACLES["op5_shards"] = f"""
WITH RECURSIVE points AS (SELECT CAST(i % {_S} AS INTEGER) AS shard, {_pos.format(f"md5((i % {_S}) || ':' || (i // {_S}))")} AS ends FROM range({_S * _V}) r(i)),
arcs AS (SELECT row_number() OVER (ORDER BY ends, shard) - 1 AS arc, shard, ends FROM points),
docs AS (SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, text, {_pos.format("md5(coalesce(CAST(doc_id AS VARCHAR), text, ''))")} AS pos FROM documents),
placed AS (SELECT docs.*, coalesce(arcs.arc, 0) AS arc FROM docs ASOF LEFT JOIN arcs ON docs.pos <= arcs.ends),
ranked AS (SELECT *, row_number() OVER (PARTITION BY arc ORDER BY pos, doc_id) - 1 AS rn FROM placed),
n AS (SELECT count(*) AS n FROM documents),
loads AS (SELECT a.arc, a.shard, count(r.arc) AS held FROM arcs a LEFT JOIN ranked r ON a.arc = r.arc GROUP BY a.arc, a.shard),
l AS (SELECT *, coalesce(sum(held) OVER (PARTITION BY shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(held) OVER (PARTITION BY shard) AS home, n // {_S} + CASE WHEN shard < n % {_S} THEN 1 ELSE 0 END AS cap FROM loads, n),
m AS (SELECT *, CAST(greatest(0, least(held, before + held - cap)) AS BIGINT) AS waiting FROM l),
q AS (SELECT *, CAST(sum(waiting) OVER (ORDER BY arc) - waiting AS BIGINT) AS waiting_before FROM m),
visits AS (SELECT CAST(arc + 1 AS BIGINT) AS step, shard, waiting_before + waiting AS tail FROM q
  UNION ALL SELECT CAST(arc + {_S * _V} + 1 AS BIGINT), shard, (SELECT CAST(sum(waiting) AS BIGINT) FROM q) FROM q),
walk AS (SELECT CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS head, (SELECT list(room ORDER BY shard) FROM (SELECT DISTINCT shard, CAST(greatest(0, cap - home) AS BIGINT) AS room FROM q)) AS rooms,
    CAST(0 AS BIGINT) AS take, 0 AS shard, CAST(0 AS BIGINT) AS room
  UNION ALL SELECT v.step, w.head + least(greatest(v.tail - w.head, 0), w.rooms[v.shard + 1]),
    list_transform(w.rooms, lambda x, i: CASE WHEN i = v.shard + 1 THEN x - least(greatest(v.tail - w.head, 0), x) ELSE x END),
    least(greatest(v.tail - w.head, 0), w.rooms[v.shard + 1]), v.shard, w.rooms[v.shard + 1] FROM walk w JOIN visits v ON v.step = w.step + 1),
caps AS (SELECT DISTINCT shard, cap FROM q),
parts AS (SELECT head - take AS first, head AS until, walk.shard, cap - room AS slot FROM walk JOIN caps ON caps.shard = walk.shard WHERE take > 0),
tab AS (SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, c)) AS t),
sums AS (SELECT text, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
  lambda x, b: xor(x >> 8, t[(xor(x, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents), tab),
o AS (SELECT r.*, q.shard AS home, q.before, q.held - q.waiting AS stay, q.waiting_before + r.rn - (q.held - q.waiting) AS w FROM ranked r JOIN q ON r.arc = q.arc)
SELECT o.doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(NULL AS INTEGER) AS grown_shard, CAST(CASE WHEN rn < stay THEN home ELSE parts.shard END AS INTEGER) AS shard,
  CAST(CASE WHEN rn < stay THEN before + rn ELSE parts.slot + w - parts.first END AS BIGINT) AS slot
FROM o JOIN sums ON coalesce(o.text, '') = sums.text LEFT JOIN parts ON rn >= stay AND first <= w AND w < until
"""


def _buckets(buckets: int = 16, budget: int = 16_384) -> str:
    """The dynamic programme, a layer for each further bucket, and the way back through its choices."""
    layers = []
    for k in range(2, buckets + 1):
        layers.append(
            f"v{k} AS (SELECT b.j, min(a.best + b.size * (b.held - a.held) - (b.total - a.total)) AS v, "
            f"arg_min(a.j, (a.best + b.size * (b.held - a.held) - (b.total - a.total)) * 1000000 + a.j) AS c "
            f"FROM d{k - 1} a JOIN h b ON a.j < b.j GROUP BY b.j),\n"
            f"d{k} AS MATERIALIZED (SELECT o.j, o.size, o.held, o.total, least(o.best, coalesce(v, o.best)) AS best, "
            f"CASE WHEN v < o.best THEN c END AS choice FROM d{k - 1} o LEFT JOIN v{k} ON o.j = v{k}.j)"
        )
    back = [f"b{buckets + 1} AS (SELECT max(j) AS j FROM h)"]
    ends = []
    for k in range(buckets, 1, -1):
        back.append(f"b{k} AS (SELECT coalesce(choice, b{k + 1}.j) AS j, choice IS NOT NULL AND b{k + 1}.j > 0 AS ended FROM b{k + 1} JOIN d{k} ON d{k}.j = b{k + 1}.j)")
        ends.append(f"SELECT b{k + 1}.j FROM b{k + 1}, b{k} WHERE b{k}.ended")
    ends.append("SELECT j FROM b2 WHERE j > 0")
    return f"""
WITH docs AS (SELECT doc_id, CAST({_WORDS} AS BIGINT) AS length, md5(CAST(doc_id AS VARCHAR)) AS digest FROM documents),
g AS (SELECT length AS size, count(*) AS c FROM docs GROUP BY length),
h AS MATERIALIZED (SELECT row_number() OVER (ORDER BY size) AS j, size, CAST(sum(c) OVER (ORDER BY size) AS BIGINT) AS held, CAST(sum(c * size) OVER (ORDER BY size) AS BIGINT) AS total FROM g
  UNION ALL SELECT 0, 0, 0, 0),
d1 AS MATERIALIZED (SELECT j, size, held, total, CASE WHEN j = 0 THEN 0 ELSE size * held - total END AS best FROM h),
{",\n".join(layers)},
{",\n".join(back)},
ends AS (SELECT DISTINCT size AS boundary FROM h WHERE j IN ({" UNION ".join(ends)})),
e AS (SELECT boundary, coalesce(lag(boundary) OVER (ORDER BY boundary), -1) AS above, row_number() OVER (ORDER BY boundary) - 1 AS bucket FROM ends),
p AS (SELECT docs.*, bucket, boundary, row_number() OVER (PARTITION BY bucket ORDER BY digest) - 1 AS rank, greatest({budget} // greatest(boundary, 1), 1) AS per
  FROM docs JOIN e ON length > above AND length <= boundary)
SELECT doc_id, length, CAST(bucket AS INTEGER) AS bucket, boundary, rank // per AS batch, rank % per AS place, boundary - length AS padding FROM p
"""


ORACLES["op7_length_buckets"] = _buckets()

ORACLES["op9_nn_descent"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS n, vec_id AS r FROM embeddings UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.n),
c AS (SELECT n, min(r) AS component_id FROM reach GROUP BY n),
d AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON vec_id = n LEFT JOIN d ON vec_id = a
"""

_PARTS = ["CAST(doc_id AS VARCHAR)", "source", "lang", "{n}", "text"]


def _leaf(n: str) -> str:
    parts = [p.format(n=n) for p in _PARTS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({p})) || ':' || {p}, '-')" for p in parts) + ")"


#: The unsigned CRC-32 of a short ASCII string: eight steps per byte over the reflected polynomial.
_CRC = (
    "list_reduce(list_concat([CAST(4294967295 AS UBIGINT)], list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS UBIGINT))), "
    "lambda crc, c: list_reduce(list_concat([xor(crc, c)], list_transform(range(8), lambda i: CAST(i AS UBIGINT))), "
    "lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END))"
)


_FOLD = (
    "list_reduce(list_concat([[{0}]], {1}), lambda h, s: [sha256(CASE WHEN s[1] = 'l' THEN s[2] || h[1] ELSE h[1] || s[2] END)])[1]"
)

ORACLES["op12_merkle"] = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, lang, {_leaf("CAST(n_chars AS VARCHAR)")} AS leaf,
    CASE WHEN xor({_CRC.format("CAST(doc_id AS VARCHAR)")}, CAST(4294967295 AS UBIGINT)) % 7 = 0 THEN {_leaf("CAST(n_chars + 1 AS VARCHAR)")} END AS other FROM documents),
p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t AS (SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY lang
  UNION ALL SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM t WHERE len(nodes) > 1),
g AS MATERIALIZED (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM t WHERE len(nodes) = 1),
u AS (SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM g
  UNION ALL SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM u WHERE len(nodes) > 1),
s AS (SELECT p.doc_id, p.pos, p.lang, t.level, CASE WHEN (p.pos >> t.level) & 1 = 1 THEN 'l' ELSE 'r' END AS side,
    coalesce(t.nodes[xor(p.pos >> t.level, 1) + 1], '') AS sibling FROM p JOIN t ON p.lang IS NOT DISTINCT FROM t.lang WHERE len(t.nodes) > 1
  UNION ALL SELECT p.doc_id, p.pos, p.lang, 1000 + u.level, CASE WHEN (g.pos >> u.level) & 1 = 1 THEN 'l' ELSE 'r' END,
    coalesce(u.nodes[xor(g.pos >> u.level, 1) + 1], '') FROM p JOIN g ON p.lang IS NOT DISTINCT FROM g.lang, u WHERE len(u.nodes) > 1),
w AS (SELECT lang, pos, list([side, sibling] ORDER BY level) AS way, string_agg(sibling, '' ORDER BY level) AS proof FROM s GROUP BY lang, pos),
f AS (SELECT p.*, coalesce(w.proof, '') AS proof, {_FOLD.format("coalesce(p.other, p.leaf)", "coalesce(w.way, [])")} AS folded_root
  FROM p LEFT JOIN w ON p.lang IS NOT DISTINCT FROM w.lang AND p.pos = w.pos)
SELECT f.doc_id, f.leaf, g.subroot, r.root, sha256(f.proof) AS proof_sha256, f.folded_root, f.folded_root = r.root AS verified
FROM f JOIN g ON f.lang IS NOT DISTINCT FROM g.lang, (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1) r
"""


def _clusters(k: int = 40, rounds: int = 5, d: int = 64) -> str:
    """Every round as a table of its own: centroids, then the nearest of each point."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT n, arg_min(c, dist * 1000 + c) AS c, min(dist) AS dist FROM (SELECT p.n, m.c, "
            f"list_sum(list_transform(list_zip(p.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist FROM p, c{r} m) GROUP BY n)"
        )
        if r < rounds:
            steps.append(
                f"s{r} AS (SELECT c, i, sum(x) AS t, count(*) AS z FROM (SELECT a.c, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS i FROM a{r} a JOIN p USING (n)) GROUP BY c, i)"
            )
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT m.c, coalesce(x.v, m.v) AS v FROM c{r} m LEFT JOIN "
                f"(SELECT c, list(CAST((t - ((t % z) + z) % z) // z AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY c) x USING (c))"
            )
    return f"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM p QUALIFY c < {k}),
{",\n".join(steps)}
SELECT p.vec_id, CAST(a.c AS INTEGER) AS cluster, a.dist AS distance, CAST(sum(a.dist) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.dist) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM p JOIN a{rounds} a USING (n) JOIN c{rounds} m ON m.c = a.c
"""


ORACLES["op13_bisectors"] = _clusters()
