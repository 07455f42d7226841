"""DuckDB SQL of the operators whose whole result SQL can state (line dedup's is beside its query)."""

# CRC-32 over a list of bytes, with the table of the reflected polynomial 0xEDB88320.
_CRC = """
step AS (
  WITH RECURSIVE s(b, k, c) AS (
    SELECT range, 0, range::BIGINT FROM range(256)
    UNION ALL SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM s WHERE k < 8)
  SELECT list(c ORDER BY b) AS t FROM s WHERE k = 8)"""

# Each level: the child with the smallest draw, an exponential number of the child's weight as its rate.
_DRAW = "-ln((('0x' || substr(sha256(key || ':' || {name}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / {weight}"


def _descend(shards: int) -> str:
    """Shards of weight 1 in 4 regions of 2 racks; a 17th has a region and a rack of its own."""
    return f"""
  SELECT id, arg_min(shard, draw) AS shard FROM (
    SELECT id, shard, {_DRAW.format(name="leaf", weight="1")} AS draw FROM (
      SELECT id, key, arg_min(rack, draw) AS rack FROM (
        SELECT id, key, rack, {_DRAW.format(name="rack", weight="weight")} AS draw FROM (
          SELECT id, key, arg_min(region, draw) AS region FROM (
            SELECT id, key, region, {_DRAW.format(name="region", weight="weight")} AS draw
            FROM d, (SELECT region, count(*) AS weight FROM leaves WHERE shard < {shards} GROUP BY ALL)) GROUP BY id, key)
        JOIN (SELECT region, rack, count(*) AS weight FROM leaves WHERE shard < {shards} GROUP BY ALL) USING (region)) GROUP BY id, key)
    JOIN leaves USING (rack) WHERE shard < {shards}) GROUP BY id"""


ORACLE_SQL = {
    "op11_sharding": f"""
WITH {_CRC},
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(doc_id::VARCHAR, '') AS key, coalesce(text, '') AS text FROM documents),
leaves AS (
  SELECT s AS shard, region::VARCHAR AS region, region || '/' || rack AS rack, region || '/' || rack || '/' || s AS leaf
  FROM (SELECT s, s // 4 AS region, CASE WHEN s < 16 THEN (s // 2) % 2 ELSE 0 END AS rack FROM range(17) r(s))),
now AS ({_descend(16)}),
later AS ({_descend(17)}),
bytes AS (SELECT id, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda y: ('0x' || y)::BIGINT) AS b FROM d),
sums AS (
  SELECT id, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) AS crc
  FROM bytes, step),
f AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT + 1 AS size, crc AS text_crc32, now.shard::INTEGER AS shard, later.shard::INTEGER AS grown_shard
  FROM d JOIN now USING (id) JOIN later USING (id) JOIN sums USING (id))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM f
""",
    "op12_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
    ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, '<P>' || substr(text, 1, a) AS p, '<M>' || substr(text, a + 1, b - a) AS m, '<S>' || substr(text, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM s
""",
    "op13_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM own GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 1)) // (coalesce(s.total, 0) + l.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN sums s USING (lang, source)
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM rows)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
""",
}
