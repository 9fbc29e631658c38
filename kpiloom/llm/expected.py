"""Expected results of the decontamination and manifest queries in SQL."""

from __future__ import annotations

#: Words of documents and items once A-Z is lower-cased.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontamination(window: int) -> str:
    """Windows of both sides as joined words, by length; a document's hit words are the distinct places that any covers."""
    return f"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS}, []) AS w FROM documents),
    i AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
    sized AS (SELECT *, least({window}, len(w)) AS k FROM i WHERE len(w) > 0),
    wanted AS (SELECT DISTINCT item_id, k, array_to_string(w[p + 1 : p + k], ' ') AS g FROM (SELECT *, unnest(range(len(w) - k + 1)) AS p FROM sized)),
    lengths AS (SELECT DISTINCT k FROM sized),
    met AS (FROM (SELECT r, k, w, unnest(range(len(w) - k + 1)) AS p FROM d, lengths WHERE len(w) >= k) SELECT r, p, k, array_to_string(w[p + 1 : p + k], ' ') AS g),
    found AS (SELECT r, p, met.k, item_id FROM met JOIN wanted ON met.k = wanted.k AND met.g = wanted.g),
    hits AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS place FROM (SELECT DISTINCT r, p, k FROM found)) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""


def manifest(fan: int, levels: int = 6, upper: int = 3) -> str:
    """Levels written out one by one; holds for branches of up to fan^levels rows and fan^upper branches."""
    fields = " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        """remainders AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
          lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t)""",
        """sums AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295)::BIGINT AS crc FROM documents, remainders)""",
        f"""hashed AS (SELECT doc_id, source, sha256({fields.format(text='text')}) AS leaf, sha256({fields.format(text='shown')}) AS presented
          FROM (SELECT *, CASE WHEN crc % 5 = 0 THEN {lowered} ELSE text END AS shown FROM sums))""",
        """leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, presented) - 1 AS n, count(*) OVER (PARTITION BY source) AS w FROM hashed)""",
        "b0 AS (SELECT source, n, w, leaf AS h FROM leaves)",
    ]
    for k in range(levels):
        parts.append(f"b{k + 1} AS (SELECT source, n // {fan} AS n, (w + {fan - 1}) // {fan} AS w, list(h ORDER BY b.n) AS kids, sha256(string_agg(h, '' ORDER BY b.n)) AS h FROM b{k} b WHERE w > 1 GROUP BY source, b.n // {fan}, w)")
    parts.append("tops AS (" + " UNION ALL ".join(f"SELECT source, h FROM b{k} WHERE w = 1" for k in range(levels + 1)) + ")")
    parts.append("t0 AS (SELECT 0 AS source, source AS branch, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS n, count(*) OVER () AS w, h FROM tops)")
    for k in range(upper):
        parts.append(f"t{k + 1} AS (SELECT source, n // {fan} AS n, (w + {fan - 1}) // {fan} AS w, list(h ORDER BY t.n) AS kids, sha256(string_agg(h, '' ORDER BY t.n)) AS h FROM t{k} t WHERE w > 1 GROUP BY source, t.n // {fan}, w)")
    parts.append("root AS (" + " UNION ALL ".join(f"SELECT h AS root FROM t{k} WHERE w = 1" for k in range(upper + 1)) + ")")
    parts.append("""c0 AS (SELECT doc_id, l.source, leaf, t0.h AS subroot, root, l.n, presented AS folded, '' AS proof, t0.n AS rank
      FROM leaves l JOIN t0 ON l.source IS NOT DISTINCT FROM t0.branch, root)""")
    steps = [("b", "n", k) for k in range(levels)] + [("t", "rank", k) for k in range(upper)]
    for i, (kind, place, k) in enumerate(steps):
        at = f"(c.{place} // {fan**k})"
        match = f"k.n = {at} // {fan}" + (" AND k.source IS NOT DISTINCT FROM c.source" if kind == "b" else "")
        parts.append(f"""c{i + 1} AS (SELECT doc_id, source, leaf, subroot, root, n, rank, CASE WHEN kids IS NULL THEN folded ELSE sha256(concat(earlier, folded, later)) END AS folded,
          CASE WHEN kids IS NULL THEN proof ELSE concat(proof, earlier, later) END AS proof
          FROM (SELECT c.*, k.kids, array_to_string(k.kids[1 : {at} % {fan}], '') AS earlier, array_to_string(k.kids[{at} % {fan} + 2 : ], '') AS later
          FROM c{i} c LEFT JOIN {kind}{k + 1} k ON {match}))""")
    return "WITH " + ",\n    ".join(parts) + f"""
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM c{len(steps)}"""
