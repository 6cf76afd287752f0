"""The registered queries of this subpackage and the SQL that some must equal.

Each query applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, fingerprints, jaccard, langid, merkle, mixing, nearest, outliers, packing, pii, repeats, sharding, trie, window_dedup


def _led_by(df: DataFrame, *names: str) -> DataFrame:
    """The frame with these columns first."""
    return df.select(*names, *[c for c in df.columns if c not in names])


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~held_out))
    return _led_by(langid.predict(docs, model).withColumn("held_out", held_out), "doc_id", "held_out", "lang_pred", "score")


#: A megabyte, so that the given tables need a directory; files in use are some hundred times that.
SHARD_BYTES = 1 << 20


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(common.table(spark, sf_dir, "documents"), limit=SHARD_BYTES)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = nearest.usable(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest.search(vectors, vectors.where("id % 100 = 0"))


def op4_outlier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outliers.judge(common.table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return _led_by(found, "doc_id", *counts, "base_failed", "kept")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans(common.table(spark, sf_dir, "documents"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(spark, sf_dir, "documents"))


def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.kept_bytes(common.table(spark, sf_dir, "documents"))


def op8_shingle_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(common.table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _led_by(mixing.mix(common.table(spark, sf_dir, "documents")), "doc_id", "size", "source_size", "target", "taken")


def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.kept_words(common.table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(common.table(spark, sf_dir, "documents"))


def op12_rare_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(common.table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(common.table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


OP9_SQL = """
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
), weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM totals
), leveled AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
), chosen AS (
  SELECT level FROM leveled WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1
), budgets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) AS target,
         floor(least(cap, coalesce((SELECT level FROM chosen) * weight, cap)) + 0.5)::BIGINT AS budget
  FROM leveled
), epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // greatest(source_size, 1) ELSE 0 END AS epochs FROM budgets
), places AS (
  SELECT d.source, key, doc_id, size, count(*) AS copies, any_value(source_size) AS source_size,
         any_value(target) AS target, any_value(epochs) AS epochs, any_value(budget - epochs * source_size) AS rest
  FROM docs d JOIN epochs e ON d.source IS NOT DISTINCT FROM e.source GROUP BY d.source, key, doc_id, size
), running AS (
  SELECT *, sum(size * copies) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size) - size * copies AS start FROM places
)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + CASE WHEN start + size * copies <= rest THEN size WHEN start >= rest THEN 0
                             ELSE (rest - start) // copies END)::BIGINT AS taken
FROM running, range(copies)
"""


OP10_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), g AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w)
), r AS (
  SELECT h FROM g GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM g JOIN r USING (h), range(35) t(k)
), each_word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w
), marked AS (
  SELECT e.doc_id, e.p, word, gone.p IS NOT NULL AS removed FROM each_word e LEFT JOIN gone ON e.doc_id = gone.doc_id AND e.p = gone.p
), sums AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN sums ON w.doc_id = sums.doc_id
"""

OP7_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), g AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 800)) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 399)) AS i FROM d)
), r AS (
  SELECT h FROM g GROUP BY h HAVING count(*) > 1
), hit AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g JOIN r USING (h)
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit
), runs AS (
  SELECT doc_id, run, min(i) AS low, max(i) + 400 AS high FROM numbered GROUP BY doc_id, run
), kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs FROM runs GROUP BY doc_id
)
SELECT d.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(array_to_string([substr(x, 2 * p[1] + 1, 2 * (p[2] - p[1])) FOR p IN
    list_zip(list_concat([0], coalesce(highs, [])), list_concat(coalesce(lows, []), [length(x) // 2]))], ''))) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


OP8_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) > 2 THEN [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)]
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 90 * (x.size + y.size - k)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)
"""


OP2_SQL = f"""
WITH d AS (
  SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key, coalesce(strlen(text), 0)::BIGINT AS bytes FROM documents
), each_depth AS (
  SELECT doc_id, bytes, depth, (1::BIGINT << depth) + (key >> (60 - depth)) AS node FROM d, range(0, 61) t(depth)
), nodes AS (
  SELECT depth, node, sum(bytes)::BIGINT AS shard_bytes, count(*) AS n FROM each_depth GROUP BY ALL
), fitting AS (
  SELECT doc_id, bytes, e.depth, e.node, shard_bytes, row_number() OVER (PARTITION BY doc_id ORDER BY e.depth) AS nth
  FROM each_depth e JOIN nodes n ON e.depth = n.depth AND e.node = n.node WHERE shard_bytes <= {SHARD_BYTES} OR n = 1
)
SELECT doc_id, bytes, node AS shard_id, 0::BIGINT AS overflow, depth::INTEGER AS depth, shard_bytes FROM fitting WHERE nth = 1
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    bits = f"flatten([[(ascii(c) >> k) & 1 FOR k IN range(8)] FOR c IN string_split({text}, '')])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda x, b: xor(x >> 1, (xor(x, b) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"


def _value(expr: str) -> str:
    return f"coalesce(strlen({expr})::VARCHAR || ':' || {expr}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_value(x) for x in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


#: Trees level by level: (tree, level, place, digest, how many); a tree of one node is done.
OP11_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT *, {_leaf('text')} AS leaf FROM documents)
), trees AS (
  SELECT source, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM l
  UNION ALL
  SELECT source, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16 FROM trees WHERE n > 1 GROUP BY source, level, pos // 16
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM trees WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16 FROM tops WHERE n > 1 GROUP BY level, pos // 16
), sibs AS (
  SELECT l.source, l.pos AS leaf_at, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos < l.pos // (16 ** t.level)::BIGINT), '') AS lefts,
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos > l.pos // (16 ** t.level)::BIGINT), '') AS rights
  FROM l JOIN trees t ON t.source IS NOT DISTINCT FROM l.source AND t.n > 1 AND t.pos // 16 = l.pos // (16 ** (t.level + 1))::BIGINT GROUP BY ALL
), top_sibs AS (
  SELECT s.source, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos < s.pos // (16 ** t.level)::BIGINT), '') AS lefts,
    coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos > s.pos // (16 ** t.level)::BIGINT), '') AS rights
  FROM subroots s JOIN tops t ON t.n > 1 AND t.pos // 16 = s.pos // (16 ** (t.level + 1))::BIGINT GROUP BY ALL
), steps AS (
  SELECT source, leaf_at, row_number() OVER (PARTITION BY source, leaf_at ORDER BY stage, level) AS step, lefts, rights FROM (
    SELECT source, leaf_at, 0 AS stage, level, lefts, rights FROM sibs
    UNION ALL SELECT l.source, l.pos, 1, t.level, t.lefts, t.rights FROM l JOIN top_sibs t ON l.source IS NOT DISTINCT FROM t.source)
), fold AS (
  SELECT source, pos, 0::BIGINT AS step, CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN lowered ELSE leaf END AS digest FROM l
  UNION ALL
  SELECT f.source, f.pos, s.step, sha256(lefts || f.digest || rights) FROM fold f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.pos = s.leaf_at AND s.step = f.step + 1
), proofs AS (
  SELECT source, leaf_at, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof, max(step) AS steps FROM steps GROUP BY ALL
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = t.digest AS verified
FROM l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN tops t ON t.n = 1
LEFT JOIN proofs p ON l.source IS NOT DISTINCT FROM p.source AND l.pos = p.leaf_at
JOIN fold f ON l.source IS NOT DISTINCT FROM f.source AND l.pos = f.pos AND f.step = coalesce(p.steps, 0)
"""


OP13_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) - 1 AS p, name, w FROM (
    SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS w FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, c - c % 20 AS b, {_crc32('c::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT c FROM own)
), lent AS (
  SELECT k.c, h, coalesce(count(o.c), 0) AS l FROM convs k LEFT JOIN own o ON o.c = k.b AND o.p < k.h GROUP BY ALL
), t AS (
  SELECT k.c, o.p, name, w FROM convs k JOIN own o ON o.c = k.b AND o.p < k.h
  UNION ALL SELECT o.c, o.p - h + l, name, w FROM own o JOIN lent USING (c) WHERE o.p >= h
), path AS (
  SELECT c, p + 1 AS d, w, md5(string_agg(name, '') OVER (PARTITION BY c ORDER BY p)) AS k FROM t
  UNION ALL SELECT c, 0, 0, '' FROM convs
), n AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w FROM path GROUP BY d, k
), up AS (
  SELECT DISTINCT a.d, a.k, b.d AS pd, b.k AS pk FROM path a JOIN path b ON a.c = b.c AND a.d = b.d + 1
), kids AS (
  SELECT pd AS d, pk AS k, count(*) AS n_children FROM up GROUP BY ALL
), below AS (
  SELECT DISTINCT b.d, b.k, a.d AS ad, a.k AS ak FROM path a JOIN path b ON a.c = b.c AND a.d <= b.d
), sums AS (
  SELECT ad AS d, ak AS k, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM below JOIN n USING (d, k) LEFT JOIN kids USING (d, k) GROUP BY ALL
), ends AS (
  SELECT d, k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM path JOIN (SELECT c, max(d) AS d FROM path GROUP BY c) USING (c, d) GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
  saved::BIGINT AS saved_tokens, coalesce(ends.h, sha256('')) AS ends_sha256
FROM n LEFT JOIN up USING (d, k) LEFT JOIN n m ON m.d = up.pd AND m.k = up.pk LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k
JOIN sums ON sums.d = n.d AND sums.k = n.k LEFT JOIN ends ON ends.d = n.d AND ends.k = n.k
"""


def oracle_sql() -> dict:
    return {"op2_shards": OP2_SQL, "op8_shingle_links": OP8_SQL, "op9_mix_sources": OP9_SQL, "op7_repeated_bytes": OP7_SQL, "op10_repeated_windows": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op13_prefix_trie": OP13_SQL}
