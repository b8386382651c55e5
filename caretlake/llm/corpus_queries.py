"""Queries of the operators on related and similar records over the whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretlake.functions.labels import clean_split
from caretlake.llm import splits
from caretlake.llm.incremental import IncrementalDedup, as_texts, nothing_new
from caretlake.llm.neardup import near_duplicates
from caretlake.llm.overlap import EVALUATION, cross_split, partners
from caretlake.session import table

SIMILAR = 0.6  # what TESTDATA.md states for problems 4, 6 and 7


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.broken_ties(table(spark, d, "jobs"), table(spark, d, "samples")).select("repository_id")


def p1_components(spark: SparkSession, d: str) -> DataFrame:
    """Every repository with its related set, named by its smallest group, or by itself if it is alone."""
    return splits.related_sets(table(spark, d, "jobs"), table(spark, d, "samples"))


def p1_assignment(spark: SparkSession, d: str) -> DataFrame:
    return splits.grouped_splits(table(spark, d, "jobs"), table(spark, d, "samples"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    a = p1_assignment(spark, d)
    total = a.agg(F.sum("samples").alias("total"))
    return a.groupBy("split").agg(F.count("*").alias("repositories"), F.sum("samples").alias("samples")).crossJoin(F.broadcast(total)).select("split", "repositories", "samples", F.round(F.col("samples") / F.col("total"), 4).alias("share"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    r = near_duplicates(table(spark, d, "corpus_files"), "file_id", "content", SIMILAR)
    return r.pairs().toDF("file_id_a", "file_id_b")


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    r = near_duplicates(table(spark, d, "corpus_files"), "file_id", "content")
    return r.documents().withColumnRenamed("id", "file_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return nothing_new(table(spark, d, "corpus_files"), table(spark, d, "file_owner"), table(spark, d, "discovery_files"), SIMILAR)


def _loaded(spark: SparkSession, d: str) -> tuple[IncrementalDedup, DataFrame]:
    """The state after loading corpus_files in two halves."""
    texts, state = as_texts(table(spark, d, "corpus_files")), IncrementalDedup(spark, SIMILAR)
    for part in ("batch <= 4", "batch > 4 OR batch IS NULL"):
        state.ingest(texts.where(part))
    return state, texts


def p6_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Each file with its cluster and the number of its set's links."""
    state, texts = _loaded(spark, d)
    return state.documents(texts).select(F.col("id").alias("file_id"), "cluster_id", "links")


def p6_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Each file that an earlier batch holds already, with the original of the best learned score."""
    return _loaded(spark, d)[0].not_new().withColumnRenamed("id", "file_id")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return cross_split(table(spark, d, "corpus_files"), table(spark, d, "samples"), SIMILAR).select("record_table", "record_key").distinct()


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    found = cross_split(table(spark, d, "corpus_files"), table(spark, d, "samples"), SIMILAR)
    return found.groupBy("record_table", "split", "repository_id").agg(F.countDistinct("record_key").alias("records"))


def p7_partners(spark: SparkSession, d: str) -> DataFrame:
    """Validation and test files with every distinct training content they are similar to, named by its smallest file."""
    f = table(spark, d, "corpus_files").select(F.col("file_id").alias("id"), F.col("content").alias("text"), clean_split(F.col("split")).alias("split"))
    sides = (f.where(F.col("split").isin(*EVALUATION)).drop("split"), f.where("split = 'train'").drop("split"))
    return partners(*sides, SIMILAR).toDF("file_id", "train_file_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_components, p1_assignment, p1_shares, p4_found, p4_classes, p6_found, p6_clusters, p6_duplicates, p7_found, p7_report, p7_partners)}

_ALL = """
w AS (SELECT file_id, batch, split, repository_id, regexp_extract_all(lower(content), '[a-z0-9_]+') AS t FROM corpus_files WHERE content IS NOT NULL),
s AS (SELECT DISTINCT file_id, batch, split, repository_id, array_to_string(t[i : i + 4], ' ') AS h
      FROM (SELECT *, unnest(range(1, greatest(len(t) - 3, 1))) AS i FROM w)),
c AS (SELECT file_id, count(*) AS n FROM s GROUP BY file_id),
p AS (SELECT x.file_id AS a, y.file_id AS b, count(*) AS m FROM s x JOIN s y ON x.h = y.h AND x.file_id < y.file_id GROUP BY ALL),
j AS (SELECT a, b FROM p JOIN c ca ON ca.file_id = a JOIN c cb ON cb.file_id = b WHERE m * 5 >= {0} * (ca.n + cb.n - m)),
g AS (SELECT file_id, batch, split, md5(string_agg(h, '|' ORDER BY h)) AS g FROM s GROUP BY ALL)
"""
_SETS = _ALL.format(3)
_SPLIT = "CASE WHEN lower(trim({0})) IN ('eval', 'val') THEN 'validation' ELSE nullif(lower(trim({0})), '') END"
_HASH = "nullif(trim(regexp_replace(lower(trim({0})), '^sha256:', '')), '')"

ORACLE = {
    "p1_found": f"""
WITH RECURSIVE t AS (
  SELECT DISTINCT repo, nullif(lower(trim(g)), '') AS g FROM (
    SELECT repo_id AS repo, grp AS g FROM jobs UNION ALL SELECT repository_id, split_group FROM samples) WHERE repo IS NOT NULL),
n AS (SELECT DISTINCT x.repo AS a, y.repo AS b FROM t x JOIN t y ON x.g = y.g),
r AS (SELECT DISTINCT repo AS a, repo AS b FROM t UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a),
s AS (SELECT DISTINCT repository_id AS repo, {_SPLIT.format('split')} AS sp FROM samples),
k AS (SELECT r.a, count(DISTINCT sp) AS n FROM r JOIN s ON s.repo = r.b WHERE sp IS NOT NULL GROUP BY r.a)
SELECT a AS repository_id FROM k WHERE n > 1 AND a IN (SELECT repo FROM s WHERE sp IS NOT NULL)""",
    "p1_components": """
WITH RECURSIVE t AS (
  SELECT DISTINCT repo, nullif(lower(trim(g)), '') AS g FROM (
    SELECT repo_id AS repo, grp AS g FROM jobs UNION ALL SELECT repository_id, split_group FROM samples) WHERE repo IS NOT NULL),
n AS (SELECT DISTINCT x.repo AS a, y.repo AS b FROM t x JOIN t y ON x.g = y.g),
r AS (SELECT DISTINCT repo AS a, repo AS b FROM t UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a)
SELECT r.a AS repository_id, coalesce(min('g|' || t.g), 'r|' || r.a) AS component FROM r JOIN t ON t.repo = r.b GROUP BY r.a""",
    "p4_classes": f"""
WITH {_ALL.format(4)},
k AS (SELECT file_id, min(file_id) OVER (PARTITION BY g) AS class_id, count(*) OVER (PARTITION BY g) AS copies FROM g),
e AS (SELECT x.class_id AS u, y.class_id AS v FROM j JOIN k x ON x.file_id = a JOIN k y ON y.file_id = b WHERE x.class_id <> y.class_id),
l AS (SELECT u, count(*) AS links FROM (SELECT u, v FROM e UNION SELECT v, u FROM e) GROUP BY u)
SELECT file_id, class_id, copies, coalesce(links, 0) AS links FROM k LEFT JOIN l ON u = class_id""",
    "p6_clusters": f"""
WITH RECURSIVE {_SETS},
k AS (SELECT file_id, coalesce(min(file_id) FILTER (batch <= 4) OVER (PARTITION BY g), min(file_id) OVER (PARTITION BY g)) AS rep FROM g),
d AS (SELECT x.rep AS u, y.rep AS v FROM j JOIN k x ON x.file_id = a JOIN k y ON y.file_id = b WHERE x.rep <> y.rep),
e AS (SELECT u, v FROM d UNION SELECT v, u FROM d),
r AS (SELECT DISTINCT rep AS u, rep AS v FROM k UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
m AS (SELECT u, min(v) AS cluster_id FROM r GROUP BY u), l AS (SELECT u, count(*) AS links FROM e GROUP BY u)
SELECT f.file_id, coalesce(cluster_id, f.file_id) AS cluster_id, coalesce(links, 0) AS links FROM corpus_files f LEFT JOIN k USING (file_id) LEFT JOIN m ON m.u = k.rep LEFT JOIN l ON l.u = k.rep""",
    "p1_assignment": """
WITH RECURSIVE t AS (
  SELECT DISTINCT repo, nullif(lower(trim(g)), '') AS g FROM (
    SELECT repo_id AS repo, grp AS g FROM jobs UNION ALL SELECT repository_id, split_group FROM samples) WHERE repo IS NOT NULL),
n AS (SELECT DISTINCT x.repo AS a, y.repo AS b FROM t x JOIN t y ON x.g = y.g),
r AS (SELECT DISTINCT repo AS a, repo AS b FROM t UNION SELECT r.a, n.b FROM r JOIN n ON r.b = n.a),
c AS (SELECT r.a AS repository_id, coalesce(min('g|' || t.g), 'r|' || r.a) AS component FROM r JOIN t ON t.repo = r.b GROUP BY r.a),
m AS (SELECT c.*, coalesce(k, 0) AS samples FROM c LEFT JOIN (SELECT repository_id, count(*) AS k FROM samples GROUP BY 1) USING (repository_id)),
z AS (SELECT component, CAST(sum(samples) AS BIGINT) AS size FROM m GROUP BY 1), q AS (SELECT CAST(sum(size) AS DOUBLE) AS total FROM z),
l AS (SELECT component, size, row_number() OVER (ORDER BY size DESC, component) AS k FROM z, q WHERE size > total * 0.05 / 10),
p AS (SELECT CAST(0 AS BIGINT) AS k, total * 0.9 AS tr, total * 0.05 AS va, total * 0.05 AS te, '' AS component, '' AS split FROM q
  UNION ALL SELECT k, tr - CASE split WHEN 'train' THEN size ELSE 0 END, va - CASE split WHEN 'validation' THEN size ELSE 0 END, te - CASE split WHEN 'test' THEN size ELSE 0 END, component, split
  FROM (SELECT l.k, tr, va, te, l.component, size, CASE WHEN va >= tr AND va >= te THEN 'validation' WHEN tr >= te THEN 'train' ELSE 'test' END AS split FROM p JOIN l ON l.k = p.k + 1)),
w AS (SELECT unnest(['train', 'validation', 'test']) AS split, unnest([greatest(tr, 0), greatest(va, 0), greatest(te, 0)]) AS w FROM (SELECT * FROM p ORDER BY k DESC LIMIT 1)),
h AS (SELECT component, split, -w / ln((CAST(('0x' || substr(sha256('20261009' || chr(31) || 'split' || chr(31) || split || chr(31) || component), 1, 13)) AS UBIGINT) + 0.5) / 4503599627370496.0) AS score FROM z, w WHERE w > 0 AND component NOT IN (SELECT component FROM l)),
s AS (SELECT component, split FROM h QUALIFY row_number() OVER (PARTITION BY component ORDER BY score DESC, split DESC) = 1 UNION ALL SELECT component, split FROM p WHERE k > 0)
SELECT repository_id, component, samples, split FROM m JOIN s USING (component)""",
    "p4_found": f"WITH {_SETS} SELECT a AS file_id_a, b AS file_id_b FROM j",
    "p6_found": f"""
WITH {_SETS},
d AS (SELECT repository_id, relative_path, max({_HASH.format('sha256')}) AS h, bool_or(coalesce(accepted, false) AND duplicate_of IS NOT NULL) AS dup
      FROM discovery_files GROUP BY ALL),
f AS (SELECT f.file_id, f.repository_id, f.batch, coalesce({_HASH.format('f.sha256')}, d.h) AS h, coalesce(d.dup, false) AS dup
      FROM corpus_files f LEFT JOIN d USING (repository_id, relative_path)),
o AS (SELECT {_HASH.format('sha256')} AS h, repo_id, batch FROM file_owner),
e AS (SELECT a AS x, b AS y FROM j UNION ALL SELECT b, a FROM j)
SELECT file_id FROM f WHERE dup
UNION SELECT f.file_id FROM f JOIN o ON o.h = f.h AND o.repo_id <> f.repository_id AND o.batch < f.batch
UNION SELECT f.file_id FROM f JOIN e ON e.x = f.file_id JOIN corpus_files g ON g.file_id = e.y WHERE g.batch < f.batch""",
    "p7_found": f"""
WITH {_SETS},
k AS (SELECT file_id, {_SPLIT.format('split')} AS sp FROM corpus_files),
e AS (SELECT a AS x, b AS y FROM j UNION ALL SELECT b, a FROM j),
q AS (SELECT sample_id, {_SPLIT.format('split')} AS sp, regexp_replace(lower(target_text), '[^a-z0-9]', '', 'g') AS t FROM samples)
SELECT DISTINCT 'corpus_files' AS record_table, CAST(u.file_id AS VARCHAR) AS record_key
FROM k u JOIN e ON e.x = u.file_id JOIN k v ON v.file_id = e.y WHERE u.sp IN ('validation', 'test') AND v.sp = 'train'
UNION SELECT DISTINCT 'samples', sample_id FROM q
WHERE sp IN ('validation', 'test') AND length(t) >= 30 AND t IN (SELECT t FROM q WHERE sp = 'train')""",
    "p7_report": f"""
WITH {_SETS},
k AS (SELECT file_id, repository_id, {_SPLIT.format('split')} AS sp FROM corpus_files),
e AS (SELECT a AS x, b AS y FROM j UNION ALL SELECT b, a FROM j),
q AS (SELECT sample_id, repository_id, {_SPLIT.format('split')} AS sp, regexp_replace(lower(target_text), '[^a-z0-9]', '', 'g') AS t FROM samples)
SELECT record_table, sp AS split, repository_id, count(DISTINCT record_key) AS records FROM (
  SELECT 'corpus_files' AS record_table, u.sp, u.repository_id, CAST(u.file_id AS VARCHAR) AS record_key
  FROM k u JOIN e ON e.x = u.file_id JOIN k v ON v.file_id = e.y WHERE u.sp IN ('validation', 'test') AND v.sp = 'train'
  UNION ALL SELECT 'samples', sp, repository_id, sample_id FROM q
  WHERE sp IN ('validation', 'test') AND length(t) >= 30 AND t IN (SELECT t FROM q WHERE sp = 'train')) GROUP BY ALL""",
    "p7_partners": f"""
WITH {_SETS},
k AS (SELECT file_id, g, {_SPLIT.format('split')} AS sp FROM g),
e AS (SELECT a AS x, b AS y FROM j UNION ALL SELECT b, a FROM j),
t AS (SELECT file_id, min(file_id) OVER (PARTITION BY g) AS first FROM k WHERE sp = 'train')
SELECT DISTINCT x AS file_id, first AS train_file_id FROM e JOIN k ON k.file_id = x JOIN t ON t.file_id = y WHERE sp IN ('validation', 'test')""",
}
ORACLE["p1_shares"] = f"""
SELECT split, count(*) AS repositories, CAST(sum(samples) AS BIGINT) AS samples, round(sum(samples) / any_value(total), 4) AS share
FROM (SELECT *, sum(samples) OVER () AS total FROM ({ORACLE["p1_assignment"]})) GROUP BY split"""
