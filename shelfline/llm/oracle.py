"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

_DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, n FROM places JOIN windows USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _level(name: str, parent: str, path: list[str], weight: str) -> str:
    """One level of the budget tree: every parent's budget shared among its children by water-filling."""
    family = f"PARTITION BY {', '.join(path[:-1])}" if path[:-1] else ""
    line = f"({family} ORDER BY capacity / weight, {path[-1]})"
    join = f"JOIN {parent} USING ({', '.join(path[:-1])})" if path[:-1] else f"CROSS JOIN {parent}"
    keys = ", ".join(path)
    return f"""
{name}_c AS (SELECT {keys}, budget, CAST(2 * sum(tokens) AS BIGINT) AS capacity, {weight} AS weight
    FROM leaves {join} GROUP BY {keys}, budget),
{name}_f AS (SELECT *, capacity * (sum(weight) OVER ({family}) - sum(weight) OVER {line} + weight)
    <= weight * (budget - sum(capacity) OVER {line} + capacity) AS filled FROM {name}_c),
{name}_r AS (SELECT *, budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({family}) AS rest,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({family}) AS open_weight,
    sum(CASE WHEN filled THEN 0 ELSE weight END) OVER {line} AS upto FROM {name}_f),
{name} AS (SELECT {keys}, CAST(CASE WHEN filled THEN capacity
    ELSE (rest * upto) // open_weight - (rest * (upto - weight)) // open_weight END AS BIGINT) AS budget FROM {name}_r)"""


_MIX = f"""
WITH d AS (SELECT doc_id, 'domain' || CAST(coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INT), 0) % 4 AS VARCHAR) AS domain,
    lang, source, CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL),
top AS (SELECT CAST(floor(sum(tokens) * 0.5) AS BIGINT) AS budget FROM leaves),
{_level("l1", "top", ["domain"], "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END")},
{_level("l2", "l1", ["domain", "lang"], "CASE lang WHEN 'en' THEN 5 ELSE 2 END")},
{_level("l3", "l2", ["domain", "lang", "source"], "1")},
p AS (SELECT *, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS part FROM leaves JOIN l3 USING (domain, lang, source)),
k AS (SELECT *, md5('7:' || epochs || ':' || doc_id) AS key FROM d JOIN p USING (domain, lang, source)),
s AS (SELECT *, part - sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens
    ROWS UNBOUNDED PRECEDING) + n_tokens AS still FROM k)
SELECT doc_id, domain, lang, source, n_tokens, CAST(epochs + CASE WHEN still > 0 THEN 1 ELSE 0 END AS BIGINT) AS copies,
    CAST(epochs * n_tokens + greatest(0, least(n_tokens, still)) AS BIGINT) AS tokens
FROM s WHERE epochs + CASE WHEN still > 0 THEN 1 ELSE 0 END > 0"""

_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text without characters above U+07FF, eight steps a byte."""
    in_bytes = "CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END"
    data = f"flatten(list_transform(string_split({text}, ''), lambda c: {in_bytes}))"
    steps = f"flatten(list_transform({data}, lambda b: [CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda r, b: xor(xor(r, b) >> 1, 3988292384 * (xor(r, b) & 1))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}), {step}), 4294967295)"


_NEAR = r"""
WITH s AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS sh
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM s WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes a ON x = a.doc_id JOIN sizes b ON y = b.doc_id WHERE 100 * c >= 85 * (a.n + b.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (WITH RECURSIVE reached AS (SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, e.y FROM reached r JOIN edges e ON r.other = e.x)
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) LEFT JOIN sizes USING (doc_id)""".format(lower=_AZ.format("coalesce(text, '')"))

_SPELLING = r"""
WITH runs AS (SELECT doc_id, {lower} AS run, count(*) AS k
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents) GROUP BY 1, 2),
marked AS (SELECT run, k, CASE WHEN length(run) >= 7 THEN {crc} ELSE 1 END AS h FROM runs WHERE length(run) >= 7),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
        SELECT k, CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM marked)
    WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
less AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, CAST(unnest(range(0, length(word))) AS INTEGER) AS i FROM words)),
pairs AS (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, min({{'less': -m, 'other': other}}) AS best FROM pairs GROUP BY 1),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 10 * n THEN best.other END AS form,
    CASE WHEN -best.less >= 10 * n THEN -best.less END AS form_n FROM words LEFT JOIN near USING (word))
SELECT word, form, coalesce(root, word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms LEFT JOIN (WITH RECURSIVE ways AS (SELECT word, form AS root, form_n AS size FROM forms WHERE form IS NOT NULL
        UNION ALL SELECT w.word, f.form, f.form_n FROM ways w JOIN forms f ON w.root = f.word WHERE f.form IS NOT NULL)
    SELECT word, arg_max(root, size) AS root FROM ways GROUP BY 1) USING (word)""".format(lower=_AZ.format("r"), crc=_crc32("doc_id || ':' || run"))


def _fields(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}) || ':' || {v} END" for v in values) + ")"


#: Levels of 16 that the SQL climbs: enough for 16 ** 6 leaves of a source, and as many sources.
_LEVELS = 6


def _climb(name: str) -> str:
    """Nodes (family, place, h) of ``name``_0 up to one per family, and every lowest node's path and way back."""
    out = []
    for k in range(_LEVELS):
        # A family's sole node stays what it is.
        run = "count(*) OVER (PARTITION BY family)"
        out.append(f"""
{name}_r{k} AS (SELECT *, {run} AS size, place // 16 AS run FROM {name}_{k}),
{name}_{k + 1} AS (SELECT family, run AS place, CASE WHEN any_value(size) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY place)) END AS h
    FROM {name}_r{k} GROUP BY family, run),
{name}_s{k} AS (SELECT a.family, a.place, any_value(a.size) AS size,
    coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS bef, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS aft
    FROM {name}_r{k} a JOIN {name}_r{k} b USING (family, run) GROUP BY a.family, a.place)""")
    return ",".join(out)


def _folded(name: str, source: str, place: str, start: str, columns: str) -> str:
    """Steps that carry ``node`` and ``proof`` from the lowest level of ``name`` to its top."""
    out, before = [], f"(SELECT {columns}, family, {place} AS place, {start} AS node, proof FROM {source})"
    for k in range(_LEVELS):
        out.append(f"""
{name}_f{k} AS (SELECT {columns}, family, d.place // 16 AS place, proof || bef || aft AS proof,
    CASE WHEN size = 1 THEN node ELSE sha256(bef || node || aft) END AS node FROM {before} d JOIN {name}_s{k} USING (family, place))""")
        before = f"{name}_f{k}"
    return ",".join(out)


_MANIFEST = f"""
WITH leaves AS (SELECT doc_id, coalesce('=' || source, '') AS family, {_fields("text")} AS leaf, {_fields(_AZ.format("text"))} AS lowered,
    {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 AS chosen FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY doc_id, leaf) - 1 AS place FROM leaves),
t_0 AS (SELECT family, place, leaf AS h FROM placed), {_climb("t")},
tops AS (SELECT family AS of, h AS subroot, row_number() OVER (ORDER BY family) - 1 AS top FROM t_{_LEVELS}),
u_0 AS (SELECT '' AS family, top AS place, subroot AS h FROM tops), {_climb("u")},
begun AS (SELECT doc_id, leaf, family, place, CASE WHEN chosen THEN lowered ELSE leaf END AS shown, '' AS proof FROM placed),
{_folded("t", "begun", "place", "shown", "doc_id, leaf")},
joined AS (SELECT doc_id, leaf, subroot, '' AS family, top, node AS shown, proof FROM t_f{_LEVELS - 1} f JOIN tops ON f.family = tops.of),
{_folded("u", "joined", "top", "shown", "doc_id, leaf, subroot")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = h AS verified
FROM u_f{_LEVELS - 1}, (SELECT h FROM u_{_LEVELS})"""

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": _DECONTAMINATE,
    "op8_mix_sources": _MIX,
    "op10_near_duplicates": _NEAR,
    "op11_spelling_variants": _SPELLING,
    "op12_manifest": _MANIFEST,
}
