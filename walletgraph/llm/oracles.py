"""DuckDB SQL for the rows of the operators that SQL can express."""

from __future__ import annotations

import re

from walletgraph.llm.licenses import TEMPLATES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_PLAIN = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

REPEATS = f"""
WITH w AS (SELECT doc_id, {_SPACED.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM w WHERE len(w) >= 50),
k AS (SELECT doc_id, p, array_to_string(w[p : p + 49], ' ') AS k FROM s),
f AS (SELECT k, min(doc_id) AS f FROM k GROUP BY k),
g AS (SELECT DISTINCT doc_id, p + unnest(range(50)) AS p FROM k JOIN f USING (k) WHERE f < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w WHERE doc_id IN (SELECT doc_id FROM g)),
r AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) FILTER (g.p IS NULL) AS kept, count(g.p) AS n FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.p = x.p GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(r.n, 0) AS n_removed, sha256(CASE WHEN r.doc_id IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM w LEFT JOIN r USING (doc_id)"""

CONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_PLAIN.format(_lower("text"))} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (SELECT item_id, {_PLAIN.format(_lower("text"))} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
m AS (SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
s AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM w, (SELECT DISTINCT n FROM m) WHERE len(w) >= n),
h AS (SELECT DISTINCT doc_id, p, s.n, item FROM s JOIN m ON m.n = s.n AND m.k = array_to_string(w[p : p + s.n - 1], ' ')),
c AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, p + unnest(range(n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPACED.format(_lower("text"))} AS w FROM documents),
n AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[p : p + 3], ' ') FOR p IN range(1, len(w) - 2)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM n),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS p, any_value(y.n) AS q, count(*) AS c FROM u x JOIN u y USING (g) WHERE x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY ALL) WHERE 100 * c >= 85 * (p + q - c)),
r(d, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN l ON r.d = l.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM n JOIN (SELECT d AS doc_id, min(c) AS component_id FROM r GROUP BY d) USING (doc_id)"""

TOP_K = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""



def wording(template: str) -> str:
    """A template as a regular expression over a text's words, each after a space."""
    parts = re.split(r"(<<.*?>>)", re.sub(r"^(\s*<<beginOptional>>.*?<<endOptional>>)|(<<beginOptional>>[^<]*<<endOptional>>\s*)$", "", template))
    out = []
    for x in parts:
        if x.startswith("<<var"):
            low, high = re.findall(r"\d+", x)
            out.append(f"(?: [^ ]+){{{low},{high}}}")
        elif x.startswith("<<"):
            out.append("(?:" if "begin" in x else ")?")
        else:
            out += [f" {w}" for w in re.findall("[a-z0-9]+", x.lower())]
    return "".join(out) + "(?: |$)"


LICENSES = f"""
WITH w AS (SELECT doc_id, {_PLAIN.format(_lower("text"))} AS w FROM documents),
j AS (SELECT doc_id, ' ' || array_to_string(w, ' ') AS j FROM w),
x AS (SELECT doc_id, unnest(w) AS a, unnest(range(len(w))) AS p FROM w),
y AS (SELECT *, lead(a) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
z AS (SELECT doc_id, p, CASE WHEN a = 'gnu' AND b = 'general' AND c = 'public' AND d = 'license' THEN 'gpl' WHEN a = 'apache' AND b = 'license' THEN 'apache' WHEN a = 'cc' AND b = 'by' THEN 'cc-by' WHEN a = 'mit' AND b = 'license' THEN 'mit' END AS label FROM y),
f AS (SELECT doc_id, count(*) AS n, min(p) AS first, max(p) AS last, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM z WHERE label IS NOT NULL GROUP BY doc_id),
t AS ({" UNION ALL ".join(f"SELECT doc_id, '{label}' AS label FROM j WHERE regexp_matches(j, '{wording(template)}')" for label, template in TEMPLATES.items())}),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM t UNION ALL SELECT doc_id, label FROM z WHERE label IS NOT NULL) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(first AS BIGINT) AS first_word, CAST(last AS BIGINT) AS last_word, coalesce(f.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
CAST(CASE WHEN w.doc_id IN (SELECT doc_id FROM t) THEN 1.0 WHEN n > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM w LEFT JOIN f USING (doc_id) LEFT JOIN l USING (doc_id)"""

AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(CAST(lang AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
l AS (SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, good, toxic, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
|| CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first < doc_id THEN 'E' ELSE '' END AS fails
FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS o FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)),
s AS (SELECT o, step, o[step] AS own, o[1:step - 1] AS before FROM (SELECT o, unnest(range(1, 6)) AS step FROM o)),
x AS (SELECT part, o, step, own, n, good, toxic, fails, contains(fails, own) AS hit, length(translate(fails, before, '')) < length(fails) AS gone FROM h, s),
r AS (SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, own, CAST(coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed,
CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails = own), 0) AS BIGINT) AS unique_fails,
CAST(coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS BIGINT) AS toxic_lost FROM x GROUP BY part, o, step, own)
SELECT * EXCLUDE (own), CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


def _field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {text})"
#: CRC-32 of a short text, bit by bit.
_CRC = """list_reduce(list_prepend(4294967295, [ord(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]), lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))"""


def _tree(name: str, nodes: str) -> str:
    """Levels (k, tree, pos, many, digest) over (tree, pos, many, digest), and the runs of siblings in them."""
    return f"""{name}(k, tree, pos, many, digest) AS (SELECT 0, tree, pos, many, digest FROM {nodes} UNION ALL SELECT k + 1, tree, pos // 8, (many + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM {name} WHERE many > 1 GROUP BY k, tree, pos // 8, many),
{name}_runs AS (SELECT k, tree, pos // 8 AS run, list(digest ORDER BY pos) AS own FROM {name} WHERE many > 1 GROUP BY k, tree, pos // 8)"""


#: From each leaf upward, where the operator goes down from the root.
MERKLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format(text=_field("text"))} AS leaf,
CASE WHEN xor({_CRC}, 4294967295) % 3 = 0 THEN {_LEAF.format(text=_field(f"translate(text, '{_UPPER}', '{_LOWER}')"))} END AS changed FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS many, leaf AS digest FROM d),
{_tree("low", "n")},
s AS (SELECT part, digest, '' AS tree, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS many FROM (SELECT tree AS part, digest FROM low WHERE many = 1)),
{_tree("top", "s")},
p AS (SELECT n.doc_id, n.leaf, coalesce(n.changed, n.leaf) AS start, s.digest AS subroot, n.pos AS a, s.pos AS b, n.tree FROM n JOIN s ON s.part = n.tree),
e AS (SELECT doc_id, 0 AS t, k, own, a // CAST(8 ** k AS BIGINT) % 8 AS i FROM p JOIN low_runs r ON r.tree = p.tree AND r.run = a // CAST(8 ** (k + 1) AS BIGINT)
UNION ALL SELECT doc_id, 1, k, own, b // CAST(8 ** k AS BIGINT) % 8 FROM p JOIN top_runs r ON r.run = b // CAST(8 ** (k + 1) AS BIGINT)),
f AS (SELECT doc_id, t, k, array_to_string(own[1 : i], '') AS l, array_to_string(own[i + 2 :], '') AS r FROM e),
g AS (SELECT doc_id, string_agg(l || r, '' ORDER BY t, k) AS proof, list(l || '|' || r ORDER BY t, k) AS steps FROM f GROUP BY doc_id),
x AS (SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, list_reduce(list_prepend(start, coalesce(steps, [])), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
FROM p LEFT JOIN g USING (doc_id), (SELECT digest AS root FROM top WHERE many = 1))
SELECT *, folded_root = root AS verified FROM x"""

LINES = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
x AS (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS p FROM s),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS k FROM x),
g AS (SELECT k, max(doc_id) AS last FROM k WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, coalesce(last <> doc_id, false) AS gone FROM k LEFT JOIN g USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

ORACLES = {
    "op2_benchmark_decontamination": CONTAMINATION,
    "op3_license_scans": LICENSES,
    "op6_suffix_array_dedup": REPEATS,
    "op7_ngram_jaccard_join": JACCARD,
    "op8_substring_dedup": REPEATS,
    "op9_exact_top_k_search": TOP_K,
    "op11_filter_interaction_audit": AUDIT,
    "op12_merkle_manifest": MERKLE,
    "op13_line_dedup": LINES,
}
