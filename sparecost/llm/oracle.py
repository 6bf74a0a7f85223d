"""The results of operators on documents as SQL for the checking database, where SQL can state them."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

EXACT = f"""
WITH norm AS (SELECT doc_id, {LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {ITEM_WORDS} AS w FROM benchmark),
p AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM i WHERE len(w) > 0),
q AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM p),
x AS (SELECT r, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
m AS (SELECT r, k, x.n, item FROM x JOIN q ON x.n = q.n AND x.g = q.g),
h AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[k:k + 2], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r),
e AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach(r, q) AS (SELECT r, r FROM d UNION SELECT reach.r, e.b FROM reach JOIN e ON reach.q = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach USING (r) JOIN d o ON o.r = reach.q GROUP BY d.r, d.doc_id
"""

PHRASES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, k, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) > 12)),
m AS (SELECT r, k FROM (SELECT r, doc_id, k, min(doc_id) OVER (PARTITION BY g) AS least FROM x) WHERE least < doc_id),
c AS (SELECT DISTINCT r, unnest(range(k, k + 13)) AS i FROM m),
u AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
t AS (SELECT u.r, string_agg(word, ' ' ORDER BY u.i) AS kept, count(*) AS n FROM u LEFT JOIN c ON c.r = u.r AND c.i = u.i WHERE c.r IS NULL GROUP BY u.r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""

# crc32 by its table of 256 remainders
CRC_TABLE = """SELECT list(v ORDER BY b) AS crc FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, s:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS b))"""


def crc32(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda o: CAST('0x' || o AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, o: xor(c >> 8, crc[(xor(c, o) & 255) + 1])), 4294967295)"


RESAMPLING = f"""
WITH remainders AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS w FROM documents),
b AS (SELECT {ITEM_WORDS} AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
names AS (SELECT f, {crc32('f')} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf), remainders),
s AS (SELECT bucket, count(*) AS n FROM df JOIN names USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bf JOIN names USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM df) AS s, (SELECT count(*) FROM bf) AS t),
gains AS (SELECT s.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (sums.s + 10000) / ((s.n + 1.0::DOUBLE) * (sums.t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT r, count(*) AS n_features, sum(gain) AS total FROM df JOIN names USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
  coalesce(CAST((total - ((total % n_features) + n_features) % n_features) // n_features AS BIGINT), 0) AS weight,
  CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
  FROM d LEFT JOIN weights USING (r)),
able AS (SELECT doc_id, row_number() OVER (ORDER BY weight + noise DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.weight + s.noise AS score, a.rank FROM scored s LEFT JOIN able a ON s.doc_id = a.doc_id AND s.n_words >= 20
  AND a.rank <= floor(25 * a.n / 100)
"""

SQL: dict[str, str] = {
    "op1_jaccard_join": JACCARD,
    "op9_phrase_dedup": PHRASES,
    "op5_exact_dedup": EXACT,
    "op11_decontamination": DECONTAMINATION,
    "op12_importance_resampling": RESAMPLING,
}
