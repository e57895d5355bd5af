"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

from riskloom.llm.licenses import LINE_TOKENS, PHRASES, TEMPLATES, need

# Lower-cased A-Z only; words of characters other than ASCII punctuation and blanks.
_FOLD = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _FOLD + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS.format(t="coalesce(text, '')")} AS w
               FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS size,
                   array_to_string(list_slice(w, i + 1, i + least(len(w), 10)), ' ') AS win
            FROM items, LATERAL (SELECT unnest(range(greatest(len(w) - 9, 1))) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
places AS (SELECT rid, size, i, array_to_string(list_slice(w, i + 1, i + size), ' ') AS win
           FROM docs, sizes, LATERAL (SELECT unnest(range(len(w) - size + 1)) AS i) WHERE len(w) >= size),
hits AS (SELECT rid, item_id, i, size FROM places JOIN windows USING (size, win)),
hit_words AS (SELECT rid, count(DISTINCT p) AS n
              FROM (SELECT DISTINCT rid, i, size FROM hits), LATERAL (SELECT unnest(range(i, i + size)) AS p) GROUP BY rid),
hit_items AS (SELECT rid, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hit_items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       hit_words.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


# sha1 is the digest of the whole payload in either engine.
OP9 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND original IS DISTINCT FROM page_id AND original IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND original IS DISTINCT FROM page_id THEN original END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""


# All (item, document) pairs that share a term, scored in whole numbers.
OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w FROM documents),
per_doc AS (SELECT rid, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM per_doc),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM df, total),
items AS (SELECT DISTINCT item_id, unnest({_WORDS.format(t="coalesce(text, '')")}) AS term FROM benchmark),
scored AS (SELECT item_id, doc_id, rid,
                  CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) AS BIGINT) AS score
           FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN per_doc USING (rid), total
           GROUP BY item_id, doc_id, rid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS r
           FROM scored WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 50
"""


# crc32 of a short text in SQL: eight steps of the polynomial for each byte.
_CRC32 = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len({t})), lambda k: ascii({t}[k + 1])::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384)))"""

# Every prefix of every rebuilt conversation, grouped; subtrees by prefix.
OP12 = f"""
WITH turns AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, octet_length(encode(coalesce(text, ''))) AS bytes,
                 substr(sha256(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')),
                        1, 32) AS digest FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS d, list(bytes ORDER BY turn NULLS FIRST, digest) AS b
          FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, d, b, CAST(xor({_CRC32.format(t="CAST(conv_id AS VARCHAR)")}, 4294967295) % 9 AS BIGINT) AS h FROM convs),
paths AS (SELECT c.conv_id, list_concat(coalesce(f.d[1:h], []), c.d[h + 1:]) AS d, list_concat(coalesce(f.b[1:h], []), c.b[h + 1:]) AS b
          FROM heads c LEFT JOIN convs f ON f.conv_id = c.conv_id - c.conv_id % 5),
steps AS (SELECT conv_id, len(d) AS size, k AS depth, array_to_string(d[1:k], '') AS node,
                 CASE WHEN k > 0 THEN array_to_string(d[1:k - 1], '') END AS parent, CASE WHEN k > 0 THEN b[k] ELSE 0 END AS bytes
          FROM paths, LATERAL (SELECT unnest(range(len(d) + 1)) AS k)),
nodes AS (SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
                 sha256(coalesce(string_agg(CASE WHEN size = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
          FROM steps GROUP BY node, parent, depth),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
above AS (SELECT substr(n.node, 1, CAST(k AS INTEGER) * 32) AS node, (n_convs - 1) * bytes AS saved, (kids.node IS NULL)::INT AS leaf
          FROM nodes n LEFT JOIN kids USING (node), LATERAL (SELECT unnest(range(n.depth + 1)) AS k)),
sums AS (SELECT node, sum(saved) AS saved, sum(leaf) AS leaves FROM above GROUP BY node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       n.ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""


def _op2() -> str:
    """All (block, template) pairs compared directly, without any filter."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ",\n".join(f"('{t.label}', {quoted(t.words())}, {quoted(t.names.split())}, {need(t)}, "
                      f"{str(len(t.words()) > LINE_TOKENS).lower()})" for t in TEMPLATES)
    phrases = ",\n".join(f"('{label}', {quoted(p.split())})" for p, label in PHRASES.items())
    return f"""
WITH templates(label, tw, names, least, long) AS (VALUES {rows}),
phrases(label, pw) AS (VALUES {phrases}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(t="coalesce(text, '')")} AS w,
                string_split({_FOLD.format(t="coalesce(text, '')")}, chr(10)) AS lines FROM documents),
places AS (SELECT rid, label, i FROM docs, phrases, LATERAL (SELECT unnest(range(len(w) - len(pw) + 1)) AS i)
           WHERE len(w) >= len(pw) AND list_contains(w, pw[1]) AND w[i + 1:i + len(pw)] = pw),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                list_sort(list(DISTINCT label)) AS base_set FROM places GROUP BY rid),
line AS (SELECT rid, unnest(lines) AS l, unnest(range(len(lines))) AS block FROM docs),
blocks AS (SELECT rid, block, {_WORDS.format(t="l").replace(_FOLD.format(t="l"), "l")} AS bw, false AS long FROM line
           UNION ALL SELECT rid, -1, w, true FROM docs),
pairs AS (SELECT rid, block, label, len(list_intersect(tw, bw)) AS common, len(tw) AS size, least
          FROM blocks JOIN templates USING (long) WHERE list_has_all(bw, names)),
met AS (SELECT *, max(common) OVER (PARTITION BY rid, block) AS top FROM pairs WHERE common >= least),
sim AS (SELECT rid, list(DISTINCT label) AS labels, max(common / size) AS score,
               count(DISTINCT block) AS n_blocks FROM met WHERE common = top GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(base_set, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_set, []), coalesce(labels, [])))), ','),
                '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score,
       CAST(coalesce(n_blocks, 0) AS BIGINT) AS n_blocks
FROM docs LEFT JOIN base USING (rid) LEFT JOIN sim USING (rid)
"""


def all_oracles() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op2_licenses": _op2(), "op9_warc": OP9, "op11_ranked_search": OP11, "op12_conversation_trie": OP12}
