"""Queries of the operators on text for training, over the whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretlake.llm import corpus_queries, handwritten, licences, mixing, packing, repetition, secrets, tokens
from caretlake.session import materialise, table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_evidence(spark, d).select("repository_id", "relative_path")


def p2_evidence(spark: SparkSession, d: str) -> DataFrame:
    return handwritten.not_by_hand(table(spark, d, "discovery_files"), table(spark, d, "corpus_files"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_files(spark, d).where("finding <> 'agreed'").select("file_id", "finding")


def p3_files(spark: SparkSession, d: str) -> DataFrame:
    return licences.file_licences(table(spark, d, "corpus_files"), table(spark, d, "license_files"), table(spark, d, "jobs"))


def p3_repositories(spark: SparkSession, d: str) -> DataFrame:
    return licences.repository_licences(table(spark, d, "license_files"), table(spark, d, "jobs"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    fields = secrets.fields_of(table(spark, d, "corpus_files"), table(spark, d, "samples"))
    return secrets.credentials(fields).select("record_table", "record_key", "field_name", "line_zero_based").distinct()


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return secrets.redacted(secrets.fields_of(table(spark, d, "corpus_files"), table(spark, d, "samples")))


def _packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    sizes = materialise(tokens.token_sizes(table(spark, d, "documents")), "token-sizes")
    kinds = table(spark, d, "pack_capacities").where("capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct().collect()  # four rows
    return packing.pack_kinds(sizes, {r["container_kind"]: r["capacity_tokens"] for r in sorted(kinds)}), sizes


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """Containers of every kind of pack_capacities with the place of each document piece and the container's unused space."""
    return _packed(spark, d)[0].withColumnRenamed("kind", "container_kind").drop("capacity")


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Every token in one container, none over its capacity, no document split without need: nothing may fail."""
    packed, sizes = _packed(spark, d)
    packed = materialise(packed, "packed")
    return packing.checks(packed, sizes)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """(container_kind, containers, tokens, unused, filled) of each kind."""
    p = p8_containers(spark, d)
    per = p.groupBy("container_kind", "container_id").agg(F.sum("length").alias("used"), F.max("unused").alias("unused"))
    g = per.groupBy("container_kind").agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.sum("unused").alias("unused"))
    return g.withColumn("filled", F.round(F.col("tokens") / (F.col("tokens") + F.col("unused")), 6))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("source", mixing.clean_source(F.col("source")))
    return materialise(tokens.token_sizes(docs, keep=["source"]), "token-sizes")


def _targets(spark: SparkSession, d: str) -> tuple[dict[str, float], dict[str, float]]:
    rows = table(spark, d, "mix_targets").collect()  # one row per source
    named = [(r["source"].strip().lower(), r["target_share"] or 0.0, r["max_repeats"]) for r in rows if r["source"]]
    return {s: t for s, t, _ in named}, {s: float(m) if m is not None else float("inf") for s, _, m in named}


def _mixed(spark: SparkSession, d: str, budget: float | None = None) -> tuple[DataFrame, mixing.Mix, dict[str, float]]:
    """The mix of ``budget`` tokens (by default as many as the sources with a target hold), its weights and the targets."""
    sized, (targets, limits) = _sized(spark, d), _targets(spark, d)
    have = mixing.source_tokens(sized)
    budget = budget or float(sum(have.get(k, 0) for k, t in targets.items() if t > 0))
    budget = min(budget, mixing.capacity(have, targets, limits))
    mix = mixing.temper_to_limits(have, targets, limits, budget)
    return mixing.realise(sized, {k: w * budget for k, w in mix.weights.items()}, limits), mix, targets


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used in a mix of as many tokens as there are, as near to the targets as the limits allow."""
    return _mixed(spark, d)[0].select("doc_id", "source", "tokens", "uses")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached by p9_mix, their errors, and the exponent at which a source met its limit."""
    used, mix, targets = _mixed(spark, d)
    return mixing.reached(used, targets, mix.held)


def p9_stream(spark: SparkSession, d: str) -> DataFrame:
    """The uses of p9_mix in the order of their passes."""
    return mixing.passes(_mixed(spark, d)[0])


def p9_plan(spark: SparkSession, d: str) -> DataFrame:
    """The weights of a mix by characters instead of tokens, and whether a source is held at its limit."""
    targets, limits = _targets(spark, d)
    docs = table(spark, d, "documents").select(mixing.clean_source(F.col("source")).alias("source"), F.length("text").alias("tokens"))
    have = mixing.source_tokens(docs)
    mix = mixing.temper_to_limits(have, targets, limits, float(sum(have.get(k, 0) for k, t in targets.items() if t > 0)))
    return spark.createDataFrame([(k, round(w, 9), k in mix.held) for k, w in mix.weights.items()], "source string, weight double, held boolean")


def p9_temperature(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached with token shares tempered to the entropy of the targets, over as many tokens as there are, within the limits."""
    sized, (targets, limits) = _sized(spark, d), _targets(spark, d)
    have = {k: v for k, v in mixing.source_tokens(sized).items() if k in targets}
    _, tempered = mixing.temper_to_entropy(have, mixing.entropy(mixing.scaled(targets)))
    budget = min(float(sum(have.values())), mixing.capacity(have, tempered, limits))
    mix = mixing.temper_to_limits(have, tempered, limits, budget)
    return mixing.reached(mixing.realise(sized, {k: w * budget for k, w in mix.weights.items()}, limits), tempered, mix.held)


def _measured(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", repetition.clean_label(F.col("lang")).alias("lang"), repetition.clean_label(F.col("source")).alias("source"))
    return repetition.repetition(docs, keep=["lang", "source"])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(_measured(spark, d)).select("doc_id")


def p10_adaptive(spark: SparkSession, d: str) -> DataFrame:
    """Documents above the threshold of their language and source, which follows the data."""
    m = materialise(_measured(spark, d), "measured")
    by = ["lang", "source"]
    sketches = materialise(repetition.share_sketches(m, by), "sketches")  # a row a group
    hit = repetition.repetitive_adaptive(m, repetition.adaptive_thresholds(sketches, by), by)
    return hit.select("doc_id", *by, "words", "repeated_words")


QUERIES = corpus_queries.QUERIES | {
    f.__name__: f
    for f in (p2_found, p2_evidence, p3_found, p3_files, p3_repositories, p5_found, p5_redacted, p8_containers, p8_checks, p8_fill, p9_mix, p9_shares, p9_stream, p9_plan, p9_temperature, p10_found, p10_adaptive)
}

_WORDS = r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}\s\p{Z}\x0b\x1c-\x1f\x85]', '', 'g'), '[\s\p{Z}\x0b\x1c-\x1f\x85]+'), lambda x: x <> '') AS w FROM documents),
r AS (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
s AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, h ORDER BY i) AS k FROM r) WHERE k > 1),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM s)),
n AS (SELECT doc_id, count(*) AS c FROM c GROUP BY doc_id)"""

ORACLE = corpus_queries.ORACLE | {
    # Names and identifiers as they stand in these tables, written for this SQL; the operator knows more forms.
    "p3_found": r"""
WITH p(id, p) AS (VALUES ('MIT', '\bmit licen[cs]e|\(mit\)'), ('ISC', '\bisc licen[cs]e'), ('Apache-2.0', 'apache (?:software )?licen[cs]e,? (?:version |v)?2|apache 2\.0|\basl 2\.0'), ('MPL-2.0', '(?:mozilla public licen[cs]e|\bmpl),? (?:version )?2\.0'),
  ('BSD-2-Clause', 'two-clause bsd|simplified bsd|bsd 2-clause'), ('BSD-3-Clause', 'three-clause bsd|new bsd|bsd 3-clause'), ('Zlib', 'zlib licen[cs]e'), ('Unlicense', '\bunlicense\b'), ('AGPL-3.0', '(?:affero general public licen[cs]e|\bagpl),? ?(?:version |v)?3'),
  ('LGPL-3.0', '(?:lesser general public licen[cs]e|\blgpl),? ?(?:version |v)?3'), ('LGPL-2.1', '(?:lesser general public licen[cs]e|\blgpl),? ?(?:version |v)?2\.1'), ('GPL-3.0', '(?:gnu general public licen[cs]e|\bgpl),? ?(?:version |v)?3'), ('GPL-2.0', '(?:gnu general public licen[cs]e|\bgpl),? ?(?:version |v)?2')),
x AS (SELECT 'f' AS k, CAST(file_id AS VARCHAR) AS key, regexp_extract(content, '^\x{FEFF}?(?:\s+|//[^\n]*|/\*(?:[^*]|\*+[^*/])*\*+/)*') AS t FROM corpus_files WHERE content IS NOT NULL
  UNION ALL SELECT 'l', repository_id, body FROM license_files UNION ALL SELECT 'j', repo_id, license FROM jobs),
n AS (SELECT k, key, trim(lower(regexp_replace(regexp_replace(t, '(?m)^[ \t]*(?://+|/\*+|\*+/?|#+)', ' ', 'g'), '[\s*]+', ' ', 'g'))) AS t FROM x WHERE t IS NOT NULL AND key IS NOT NULL),
i AS (SELECT k, key, unnest(regexp_extract_all(CASE WHEN k = 'j' THEN t ELSE regexp_extract(t, 'spdx-license-identifier: ([a-z0-9.+-]+(?: or [a-z0-9.+-]+)*)', 1) END, '[a-z0-9.+-]+')) AS id FROM n),
c AS (SELECT k, key, p.id FROM i JOIN p ON lower(p.id) = regexp_replace(rtrim(i.id, '.'), '(-only|-or-later|\+)$', '') UNION SELECT k, key, id FROM n JOIN p ON regexp_matches(t, p)),
g AS (SELECT k, key, list(DISTINCT id) AS s FROM c GROUP BY ALL),
f AS (SELECT file_id, a.s AS a, b.s AS b, d.s AS d FROM corpus_files f LEFT JOIN g a ON a.k = 'f' AND a.key = CAST(file_id AS VARCHAR) LEFT JOIN g b ON b.k = 'l' AND b.key = f.repository_id LEFT JOIN g d ON d.k = 'j' AND d.key = f.repository_id),
r AS (SELECT file_id, CASE WHEN coalesce(a, b, d) IS NULL THEN 'unknown' WHEN len(list_intersect(list_intersect(coalesce(a, b, d), coalesce(b, d, a)), coalesce(d, a, b))) = 0 THEN 'conflict' END AS finding FROM f)
SELECT file_id, finding FROM r WHERE finding IS NOT NULL""",
    "p2_found": r"""
WITH d AS (SELECT repository_id, relative_path, lower(relative_path) AS p, regexp_replace(lower(trim(skip_reason)), '[\s-]+', '_', 'g') AS r, lower(detail) AS t FROM discovery_files WHERE repository_id IS NOT NULL AND relative_path IS NOT NULL),
a AS (SELECT repository_id, relative_path FROM d WHERE r IN ('vendored_path', 'generated_path', 'generated_marker')
  OR regexp_matches(p, '(^|/)(_?vendor|vendored|_?third[_-]party|thirdparty|3rd_?party|externals?|godeps|node_modules|bower_components)/')
  OR regexp_matches(p, '(\.pb(\.gw|\.validate)?|[._]gen(erated)?|_easyjson|_ffjson|_stringer|_msgp|\.capnp|\.twirp|\.connect|_enumer|\.xo|\.sql|_grpc\.pb)\.go$|(^|/)(zz_generated[._][^/]*|generated\.[^/]*|bindata_assetfs[^/]*|bindata\.go|wire_gen\.go)$|[.-]min\.(go|js|css)$|[._]bundle\.(go|js)$|(^|/)(go\.sum|[^/]*\.lock|package-lock\.json|pnpm-lock\.yaml)$')
  OR regexp_matches(t, 'code generated|generated by|@generated|do not edit|vendored')),
c AS (SELECT DISTINCT f.repository_id, f.relative_path, content, lower(regexp_replace(regexp_extract(content, '^\x{FEFF}?(?:\s+|//[^\n]*|/\*(?:[^*]|\*+[^*/])*\*+/)*'), '\s+', ' ', 'g')) AS h, list_filter(string_split(content, chr(10)), lambda x: length(x) >= 32) AS ls FROM corpus_files f WHERE length(content) > 0),
b AS (SELECT repository_id, relative_path FROM c WHERE regexp_matches(h, 'code generated.*do not edit|@generated|machine-written|automatisch erzeugt|auto-?generated|produced by.*(during the build|by hand|manual changes)|vendored from|copied verbatim from|imported from.*(module proxy|tag|commit)|third-party code')
  OR coalesce(list_sum(list_transform(ls, lambda x: CASE WHEN length(x) >= 160 THEN length(x) ELSE 0 END)), 0) * 2 >= length(content)
  OR CAST(coalesce(list_sum(list_transform(ls, lambda x: CASE WHEN regexp_matches(trim(x, ' ' || chr(9) || chr(13)), '^(0[xX][0-9a-fA-F]{1,4},? ?)+$|^["`'']?(\\x[0-9a-fA-F]{2})+["`'']?( ?\+)?$|^["`'']?[A-Za-z0-9+/]{40,}={0,2}["`'']?( ?\+|,)?$|^([+-]?[0-9.]+, ?){5,}[0-9.+-]*$') THEN length(x) ELSE 0 END)), 0) AS BIGINT) * 2 >= length(content))
SELECT repository_id, relative_path FROM a UNION SELECT b.repository_id, b.relative_path FROM b JOIN d USING (repository_id, relative_path)""",
    "p8_checks": """SELECT container_kind AS kind, c AS "check", CAST(0 AS BIGINT) AS failed FROM (SELECT DISTINCT container_kind FROM pack_capacities WHERE capacity_tokens > 0), (VALUES ('every_token_once'), ('split_without_need'), ('over_capacity')) v(c)""",
    "p9_plan": """
WITH m AS (SELECT lower(trim(source)) AS source, target_share AS t, max_repeats AS r FROM mix_targets WHERE target_share > 0),
d AS (SELECT lower(trim(source)) AS source, sum(length(text)) AS n FROM documents GROUP BY 1),
s AS (SELECT source, t / sum(t) OVER () AS t, r * n / sum(n) OVER () AS most FROM m JOIN d USING (source) WHERE n > 0),
o AS (SELECT *, row_number() OVER w AS k, coalesce(sum(most) OVER w, 0) AS gone, 1 - coalesce(sum(t) OVER w, 0) AS open FROM s WINDOW w AS (ORDER BY most / t, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min((1 - gone) / open, k) AS scale FROM o WHERE (1 - gone) / open * t <= most * (1 + 1e-9))
SELECT source, round(least(most, coalesce(scale, 1e99) * t), 9) AS weight, coalesce(scale, 1e99) * t > most * (1 + 1e-9) AS held FROM s, f""",
    "p10_found": f"""
{_WORDS}
SELECT doc_id FROM n JOIN w USING (doc_id) WHERE c * 100 >= len(w) * 30""",
    "p10_adaptive": f"""
{_WORDS},
m AS (SELECT doc_id, nullif(lower(trim(lang)), '') AS lang, nullif(lower(trim(source)), '') AS source, len(w) AS words, coalesce(c, 0) AS repeated_words FROM documents JOIN w USING (doc_id) LEFT JOIN n USING (doc_id) WHERE len(w) > 0),
a AS (SELECT quantile_disc(repeated_words / words, 0.9) AS whole FROM m),
g AS (SELECT lang, source, 3 * (count(*) * quantile_disc(repeated_words / words, 0.9) + 500 * any_value(whole)) / (count(*) + 500) AS threshold FROM m, a GROUP BY ALL)
SELECT doc_id, m.lang, m.source, words, repeated_words FROM m JOIN g ON g.lang IS NOT DISTINCT FROM m.lang AND g.source IS NOT DISTINCT FROM m.source
WHERE repeated_words > 0 AND repeated_words >= threshold * words""",
}
