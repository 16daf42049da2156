"""DuckDB statements for the training-data queries that SQL can express, written independently of the Spark plans."""

CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), marked AS (
  SELECT *, row_number() OVER w AS n, lag(role) OVER w AS prev,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS body
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, length(body) + CASE
      WHEN prev = role THEN length('<|im_more|>')
      ELSE length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 END AS chars
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

URL_SQL = r"""
WITH pages_ AS (
  SELECT page_id, url,
         nullif(rtrim(lower(trim(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^/:?#@]+)', 1))), '.'), '') AS host,
         DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7))::BIGINT % 360 AS INTEGER) AS fetch_date
  FROM pages
), hosts AS (SELECT DISTINCT host FROM pages_ WHERE host IS NOT NULL),
log0 AS (
  SELECT host, k, ('0x' || substr(md5(host || ':' || CAST(k AS VARCHAR)), 1, 7))::BIGINT AS h
  FROM hosts, range(4) AS r(k)
), log1 AS (
  SELECT CASE (h // 1080) % 3 WHEN 0 THEN 'spam' WHEN 1 THEN 'malware' ELSE 'allow' END AS list_name,
         CASE WHEN k < 2 OR strpos(host, '.') = 0 THEN host ELSE substr(host, strpos(host, '.') + 1) END AS pattern,
         (h // 360) % 3 < 2 AS is_add, DATE '2024-01-01' + CAST(h % 360 AS INTEGER) AS day
  FROM log0
), states AS (
  SELECT list_name, pattern, day, bool_and(is_add) AS is_on FROM log1 GROUP BY ALL
), latest AS (  -- per page, list and matching pattern: the state of the last change up to the fetch date
  SELECT p.page_id, p.url, s.list_name, s.pattern, arg_max(s.is_on, s.day) AS is_on
  FROM (SELECT DISTINCT page_id, url, host, fetch_date FROM pages_) p
  JOIN states s ON (p.host = s.pattern OR ends_with(p.host, '.' || s.pattern)) AND s.day <= p.fetch_date
  GROUP BY ALL
), verdicts AS (
  SELECT page_id, url, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS active_lists,
         coalesce(max(length(pattern)) FILTER (list_name <> 'allow'), 0) AS b,
         coalesce(max(length(pattern)) FILTER (list_name = 'allow'), 0) AS a
  FROM latest WHERE is_on GROUP BY ALL
)
SELECT p.page_id, p.url, p.fetch_date, p.host, coalesce(v.active_lists, '') AS active_lists,
       CASE WHEN v.b > v.a THEN 'block' WHEN v.a > 0 THEN 'allow' ELSE 'pass' END AS verdict
FROM pages_ p LEFT JOIN verdicts v ON p.page_id IS NOT DISTINCT FROM v.page_id AND p.url IS NOT DISTINCT FROM v.url
"""

WARC_SQL = r"""
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
FROM firsts
"""

#: Unsigned CRC-32 of a number's decimal digits, bit by bit.
_CRC = r"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, (r & 1) * 3988292384 + z))))"""

_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

MERKLE_SQL = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN {_CRC.format("doc_id")} % 5 = 0 THEN {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS peers FROM leaves
), tree AS (
  SELECT 0 AS level, source, place, peers, leaf AS hash FROM placed
  UNION ALL
  SELECT level + 1, source, place // 16, (peers + 15) // 16, sha256(string_agg(hash, '' ORDER BY place))
  FROM tree WHERE peers > 1 GROUP BY level, source, place // 16, peers
), subroots AS (SELECT source, hash FROM tree WHERE peers = 1),
top_leaves AS (SELECT source, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS peers FROM subroots),
top_tree AS (
  SELECT 0 AS level, place, peers, hash FROM top_leaves
  UNION ALL
  SELECT level + 1, place // 16, (peers + 15) // 16, sha256(string_agg(hash, '' ORDER BY place))
  FROM top_tree WHERE peers > 1 GROUP BY level, place // 16, peers
), nodes AS (  -- both trees, the upper one's levels after the lower one's
  SELECT level, coalesce('s' || source, 'n') AS grp, place, peers, hash FROM tree
  UNION ALL SELECT 1000 + level, '', place, peers, hash FROM top_tree
), sides AS (
  SELECT n.level, n.grp, n.place,
         coalesce(string_agg(o.hash, '' ORDER BY o.place) FILTER (o.place < n.place), '') AS l, coalesce(string_agg(o.hash, '' ORDER BY o.place) FILTER (o.place > n.place), '') AS r
  FROM nodes n JOIN nodes o ON n.level = o.level AND n.grp = o.grp AND n.place // 16 = o.place // 16 WHERE n.peers > 1 GROUP BY ALL
), walk AS (
  SELECT row_number() OVER () AS k, doc_id, leaf, coalesce('s' || p.source, 'n') AS grp, coalesce(changed, leaf) AS hash, p.place, t.place AS top_place, t.hash AS subroot, p.place AS at, 0 AS level, '' AS proof, false AS done
  FROM placed p JOIN top_leaves t ON p.source IS NOT DISTINCT FROM t.source
), walked AS (
  SELECT * FROM walk
  UNION ALL
  SELECT k, doc_id, leaf, CASE WHEN s.level IS NULL THEN '' ELSE w.grp END, CASE WHEN s.level IS NULL THEN w.hash ELSE sha256(s.l || w.hash || s.r) END, w.place, top_place, subroot,
         CASE WHEN s.level IS NULL THEN top_place ELSE w.at // 16 END, CASE WHEN s.level IS NULL THEN 1000 ELSE w.level + 1 END,
         w.proof || coalesce(s.l || s.r, ''), s.level IS NULL AND w.grp = ''
  FROM walked w LEFT JOIN sides s ON s.grp = w.grp AND s.level = w.level AND s.place = w.at WHERE NOT w.done
), root AS (SELECT hash FROM top_tree WHERE peers = 1)
SELECT doc_id, leaf, subroot, root.hash AS root, sha256(proof) AS proof_sha256, w.hash AS folded_root, w.hash = root.hash AS verified
FROM walked w, root WHERE done
"""

TRIE_SQL = rf"""
WITH rows AS (
  SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS n
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, CAST({_CRC.format("conv_id")} % 4 AS BIGINT) AS h FROM rows),
spliced AS (
  SELECT c.conv_id, r.n, r.said FROM convs c JOIN rows r ON r.conv_id = c.base AND r.n < c.h
  UNION ALL SELECT c.conv_id, r.n, r.said FROM convs c JOIN rows r ON r.conv_id = c.conv_id AND r.n >= c.h
), paths AS (
  SELECT c.conv_id, coalesce(list(s.said ORDER BY s.n) FILTER (s.n IS NOT NULL), []) AS path FROM convs c LEFT JOIN spliced s ON s.conv_id = c.conv_id GROUP BY 1
), members AS (SELECT conv_id, len(path) AS len, unnest(range(len(path) + 1)) AS depth, path FROM paths),
nodes AS (
  SELECT list_slice(path, 1, depth) AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM members GROUP BY 1, 2
), sized AS (
  SELECT n.*, (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(node[depth][2], '[^\x20\x09-\x0D]+')) END AS own,
         list_slice(node, 1, depth - 1) AS up
  FROM nodes n
), counted AS (
  SELECT s.*, p.conv_id AS parent_conv_id, coalesce(k.n, 0) AS n_children
  FROM sized s LEFT JOIN nodes p ON s.depth > 0 AND p.depth = s.depth - 1 AND p.node = s.up
  LEFT JOIN (SELECT up, depth, count(*) AS n FROM sized WHERE depth > 0 GROUP BY ALL) k ON k.depth = s.depth + 1 AND k.up = s.node
), below AS (
  SELECT list_slice(node, 1, d) AS node, d AS depth, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves
  FROM (SELECT node, own, n_children, unnest(range(depth + 1)) AS d FROM counted) GROUP BY ALL
)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, b.leaves AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.node = c.node
"""
