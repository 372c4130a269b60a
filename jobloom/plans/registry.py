"""The queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.functions import ages, names, urls
from jobloom.functions.links import posting_id
from jobloom.operators import dedup, joins, metrics, ranking, rules, state
from jobloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL it is checked against."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def core_queries() -> dict[str, Query]:
    from jobloom.plans import lifecycle_queries  # noqa: F401  # registers its own

    return dict(QUERIES)


def core_sql() -> dict[str, str]:
    return {name: sql for name, sql in SQL.items() if name in core_queries()}


# ---------------------------------------------------------------- problems of the core


@query()
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.operators.posting_times import posting_instants

    tables = ("greenhouse_jobs", "ashby_jobs", "lever_postings", "workday_postings", "boards_final")
    return posting_instants(*(table(spark, d, n) for n in tables))


@query()
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.operators.nested import flat_fields

    tables = ("raw_records", "lever_postings", "ashby_jobs", "smartrecruiters_postings")
    return flat_fields(*(table(spark, d, n) for n in tables))


@query()
def p6_schema_paths(spark: SparkSession, d: str) -> DataFrame:
    """The flat tables all nodes of the raw records form, by schema path."""
    from jobloom.operators.nested import dewey_nodes, schema_path_counts

    return schema_path_counts(dewey_nodes(table(spark, d, "raw_records"), "row_id", "payload"))


# ---------------------------------------------------------------- shared SQL

_WORDS = "trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_NORM = "trim(regexp_replace(regexp_replace(" + _WORDS + ", '\\b(" + names.LEGAL_FORMS + ")\\b', ' ', 'g'), ' +', ' ', 'g'))"
_PLACEHOLDERS = ", ".join(f"'{p}'" for p in names.PLACEHOLDER_NAMES)
_ID = (
    "nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '\\.0+$', ''), '^(#|[a-z]{{2,5}}[-_:])\\s*([0-9]+)$', '\\2'), '^0+([0-9])', '\\1'), '')"
)
_HOST = "nullif(lower(regexp_extract(regexp_replace(trim({0}), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^(?:[^/?#@]*@)?([A-Za-z0-9._-]+)', 1)), '')"


def _ntz_us(c: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))


#: The moment ages are counted against: 2026-08-22 00:00 UTC.
NOW_US = 1_787_356_800_000_000

# ---------------------------------------------------------------- functions over the tables


@query(
    f"SELECT company, {_NORM.format('company')} AS normal, replace({_NORM.format('company')}, ' ', '') AS compact, "
    f"trim(regexp_replace({_WORDS.format('company')}, '( ({names.LEGAL_FORMS}))+$', '')) AS name, "
    f"{_WORDS.format('company')} = '' OR {_WORDS.format('company')} IN ({_PLACEHOLDERS}) AS placeholder, count(*) AS n FROM sources GROUP BY company"
)
def q_company_names(spark: SparkSession, d: str) -> DataFrame:
    by = table(spark, d, "sources").groupBy("company").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("company")
    return by.select("company", names.normalize_text(c).alias("normal"), names.normalize_compact(c).alias("compact"), names.company_name(c).alias("name"), names.is_placeholder(c).alias("placeholder"), "n")


@query(f"SELECT {_WORDS.format('position')} AS title, count(*) AS n, count(DISTINCT company) AS companies FROM sources GROUP BY 1")
def q_normalized_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").groupBy(names.ascii_words(F.col("position")).alias("title")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("company").alias("companies"))


@query(
    f"SELECT row_id, h AS host, CASE WHEN h IS NOT NULL THEN array_to_string(list_slice(string_split(h, '.'), -2, -1), '.') END AS domain FROM (SELECT row_id, {_HOST.format('url')} AS h FROM sources)"
)
def q_url_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("row_id", urls.url_host(F.col("url")).alias("host"), urls.company_domain(F.col("url")).alias("domain"))


_APPLY = "nullif(CASE WHEN regexp_matches({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]+') THEN lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*')) || regexp_replace(regexp_replace({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', ''), '/+$', '') ELSE regexp_replace({0}, '/+$', '') END, '')"
_BARE = "regexp_replace(trim(coalesce(url, '')), '#.*$', '')"


@query(f"SELECT row_id, {_APPLY.format(_BARE)} AS apply_url FROM sources")
def q_apply_urls(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("row_id", urls.apply_url(F.col("url")).alias("apply_url"))


@query(
    "SELECT cls, count(*) AS n FROM (SELECT CASE WHEN h IS NULL THEN 'none' WHEN h = 'greenhouse.example' OR h LIKE '%.greenhouse.example' THEN 'board' "
    f"WHEN h = 'remoteroles.example' OR h LIKE '%.remoteroles.example' THEN 'aggregator' ELSE 'other' END AS cls FROM (SELECT {_HOST.format('url')} AS h FROM sources UNION ALL SELECT {_HOST.format('absolute_url')} FROM greenhouse_jobs)) GROUP BY cls"
)
def q_source_classes(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "sources").select("url").unionByName(table(spark, d, "greenhouse_jobs").select(F.col("absolute_url").alias("url")))
    cls = urls.source_class(F.col("url"), F.lit(None).cast("string"), ("greenhouse.example",), ("remoteroles.example",))
    return links.groupBy(cls.alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT row_id, lower(regexp_extract(absolute_url, '(?i)boards\\.greenhouse\\.[a-z]+/(?:embed/job_app\\?for=)?([A-Za-z0-9_-]+)', 1)) AS identifier FROM greenhouse_jobs "
    "WHERE regexp_matches(absolute_url, '(?i)boards\\.greenhouse\\.[a-z]+/(?:embed/job_app\\?for=)?[A-Za-z0-9_-]+')"
)
def q_board_references(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "greenhouse_jobs").select("row_id", urls.board_reference(F.col("absolute_url")).alias("ref"))
    return refs.filter(F.col("ref").isNotNull()).select("row_id", F.col("ref.identifier").alias("identifier"))


@query(
    "SELECT row_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(content, ''), '&lt;', '<', 'g'), '&gt;', '>', 'g'), "
    "'&quot;', '\"', 'g'), '&#39;', '''', 'g'), '&nbsp;', ' ', 'g'), '&amp;', '&', 'g'), '(?s)<[^>]*>', chr(10), 'g'), '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10)) AS txt FROM greenhouse_jobs"
)
def q_html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "greenhouse_jobs").select("row_id", F.regexp_replace(names.html_to_text(F.col("content")), r"^[ \n]+|[ \n]+$", "").alias("txt"))


@query(
    f"WITH a AS (SELECT date_diff('day', TIMESTAMP '1970-01-01', TIMESTAMP '1970-01-01') z, CASE WHEN ingested_at IS NULL THEN NULL ELSE greatest(0, CAST(floor(({NOW_US} - epoch_us(ingested_at)) / 86400000000) AS BIGINT)) END AS days FROM sources) "
    "SELECT CASE WHEN days IS NULL THEN 'fresh' WHEN days <= 14 THEN 'fresh' WHEN days <= 30 THEN 'recent' WHEN days <= 60 THEN 'aging' WHEN days <= 90 THEN 'old' ELSE 'expired' END AS tier, count(*) AS n, min(days) AS youngest, max(days) AS oldest FROM a GROUP BY 1"
)
def q_age_tiers(spark: SparkSession, d: str) -> DataFrame:
    aged = table(spark, d, "sources").select(ages.age_days(_ntz_us("ingested_at"), F.lit(NOW_US)).alias("days"))
    aged = aged.withColumn("tier", ages.age_tier(F.col("days")))
    return aged.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.min("days").alias("youngest"), F.max("days").alias("oldest"))


@query(
    "WITH t AS (SELECT company, unnest(tags) AS tag, generate_subscripts(tags, 1) AS i, row_id FROM sources WHERE company IS NOT NULL AND tags IS NOT NULL), "
    "f AS (SELECT row_id, lower(tag) AS k, min(i) AS i FROM t WHERE trim(tag) <> '' GROUP BY ALL) SELECT row_id, count(*) AS n, string_agg(k, ',' ORDER BY i) AS tags FROM f GROUP BY row_id"
)
def q_ordered_distinct_tags(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "sources").filter(F.col("company").isNotNull() & F.col("tags").isNotNull())
    out = src.select("row_id", names.ordered_distinct(F.col("tags")).alias("t"))
    return out.filter(F.size("t") > 0).select("row_id", F.size("t").cast("bigint").alias("n"), F.lower(F.array_join("t", ",")).alias("tags"))


# ---------------------------------------------------------------- the cascade

_SENIORITY = r"\b(senior|principal|director|head|vp|chief)\b"
_NO_PLACE = ("remote", "anywhere", "worldwide")


def _cascade_rules() -> list[rules.Rule]:
    """Rules over the feed's rows, in the order that decides the reason."""
    title, company = names.ascii_words(F.col("position")), names.ascii_words(F.col("company"))
    return [
        ("missing_fields", "missing_title", title == ""),
        ("missing_fields", "missing_company", company == ""),
        ("placeholder", "placeholder_company", company.isin(*names.PLACEHOLDER_NAMES)),
        ("seniority", "senior_title", title.rlike(_SENIORITY)),
        ("thin_text", "thin_description", F.length(F.coalesce("description", F.lit(""))) < 120),
        ("place", "no_place", names.ascii_words(F.col("location")).isin("", *_NO_PLACE)),
        ("stale", "late_delivery", ages.age_days(_ntz_us("ingested_at"), F.lit(NOW_US)) > 20),
    ]


_CASCADE_SQL = f"""
SELECT row_id, source_company, CASE WHEN t = '' THEN 'missing_title' WHEN c = '' THEN 'missing_company' WHEN c IN ({_PLACEHOLDERS}) THEN 'placeholder_company'
 WHEN regexp_matches(t, '{_SENIORITY}') THEN 'senior_title' WHEN length(coalesce(description, '')) < 120 THEN 'thin_description'
 WHEN l IN ('', 'remote', 'anywhere', 'worldwide') THEN 'no_place'
 WHEN greatest(0, floor(({NOW_US} - epoch_us(ingested_at)) / 86400000000)) > 20 THEN 'late_delivery' END AS reason
FROM (SELECT row_id, company AS source_company, description, ingested_at, {_WORDS.format('position')} AS t, {_WORDS.format('company')} AS c, {_WORDS.format('location')} AS l FROM sources)
"""


@query(f"SELECT row_id, reason FROM ({_CASCADE_SQL})")
def q_filter_cascade(spark: SparkSession, d: str) -> DataFrame:
    return rules.cascade(table(spark, d, "sources"), _cascade_rules()).select("row_id", "reason")


@query(
    "SELECT coalesce(CASE WHEN reason IN ('missing_title', 'missing_company') THEN 'missing_fields' WHEN reason = 'placeholder_company' THEN 'placeholder' WHEN reason = 'senior_title' THEN 'seniority' "
    "WHEN reason = 'thin_description' THEN 'thin_text' WHEN reason = 'no_place' THEN 'place' WHEN reason = 'late_delivery' THEN 'stale' END, 'kept') AS stat, coalesce(reason, '') AS reason, "
    f"count(*) AS n, count(DISTINCT source_company) AS companies FROM ({_CASCADE_SQL}) GROUP BY ALL"
)
def q_filter_cascade_accounting(spark: SparkSession, d: str) -> DataFrame:
    marked = rules.cascade(table(spark, d, "sources"), _cascade_rules())
    by = marked.groupBy(F.coalesce("stat", F.lit("kept")).alias("stat"), F.coalesce("reason", F.lit("")).alias("reason"))
    return by.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("company").alias("companies"))


@query(
    f"SELECT row_id, array_to_string(list_filter([CASE WHEN t = '' THEN 'missing_title' END, CASE WHEN c = '' THEN 'missing_company' END, CASE WHEN c IN ({_PLACEHOLDERS}) THEN 'placeholder_company' END, "
    f"CASE WHEN regexp_matches(t, '{_SENIORITY}') THEN 'senior_title' END], lambda x: x IS NOT NULL), ',') AS reasons FROM (SELECT row_id, {_WORDS.format('position')} AS t, {_WORDS.format('company')} AS c FROM sources)"
)
def q_all_reasons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("row_id", F.array_join(rules.all_reasons(_cascade_rules()[:4]), ",").alias("reasons"))


# ---------------------------------------------------------------- joins


@query(f"WITH k AS (SELECT row_id, batch_id, {_ID.format('id')} AS k FROM sources) SELECT row_id FROM k WHERE batch_id = 20 AND (k IS NULL OR k NOT IN (SELECT k FROM k WHERE batch_id < 20 AND k IS NOT NULL))")
def q_unseen_in_last_batch(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "sources").select("row_id", "batch_id", posting_id(F.col("id")).alias("k"))
    seen = keyed.filter("batch_id < 20 and k is not null").select("k")
    return joins.without_members(keyed.filter("batch_id = 20"), seen, ["k"]).select("row_id")


@query(f"WITH c AS (SELECT DISTINCT {_NORM.format('Company')} AS k FROM crm_companies) SELECT listed, count(*) AS n FROM (SELECT {_NORM.format('company')} IN (SELECT k FROM c WHERE k <> '') AND {_NORM.format('company')} <> '' AS listed FROM sources) GROUP BY listed")
def q_exclusion_list(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "crm_companies").select(names.normalize_text(F.col("Company")).alias("k")).filter("k <> ''")
    rows = table(spark, d, "sources").select(names.normalize_text(F.col("company")).alias("k"))
    return joins.flag_member(rows, listed, "k", "listed").groupBy("listed").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH a AS (SELECT DISTINCT replace({_NORM.format('company')}, ' ', '') AS name FROM sources), b AS (SELECT DISTINCT replace({_NORM.format('Company')}, ' ', '') AS listed_name FROM crm_companies) "
    "SELECT name, listed_name FROM a, b WHERE length(name) >= 5 AND length(listed_name) >= 5 AND (contains(name, listed_name) OR contains(listed_name, name)) AND least(length(name), length(listed_name)) >= 0.88 * greatest(length(name), length(listed_name))"
)
def q_contained_names(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "sources").select(names.normalize_compact(F.col("company")).alias("name")).distinct()
    b = table(spark, d, "crm_companies").select(names.normalize_compact(F.col("Company")).alias("listed_name")).distinct()
    return joins.contained_names(a, b)


@query(
    f"WITH s AS (SELECT row_id, {_NORM.format('company')} AS k, url FROM sources), hit AS (SELECT DISTINCT k FROM s WHERE url LIKE '%go.%') SELECT k, count(*) AS n FROM s WHERE k NOT IN (SELECT k FROM hit) GROUP BY k"
)
def q_whole_company_exclusion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sources").select("row_id", "url", names.normalize_text(F.col("company")).alias("k"))
    return joins.exclude_whole_group(rows, "k", F.col("url").contains("go.")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


_KNOWN = f"(SELECT row_id, {_NORM.format('company')} AS k, CASE WHEN h LIKE '%remoteroles.example' THEN NULL ELSE array_to_string(list_slice(string_split(h, '.'), -2, -1), '.') END AS domain FROM (SELECT row_id, company, {_HOST.format('url')} AS h FROM sources))"


@query(f"WITH s AS {_KNOWN}, o AS (SELECT k, min(domain) AS d FROM s WHERE domain IS NOT NULL GROUP BY k HAVING count(DISTINCT domain) = 1) SELECT s.row_id, coalesce(s.domain, o.d) AS domain FROM s LEFT JOIN o USING (k)")
def q_propagated_domains(spark: SparkSession, d: str) -> DataFrame:
    domain = urls.company_domain(F.col("url"))
    rows = table(spark, d, "sources").select("row_id", names.normalize_text(F.col("company")).alias("k"), F.when(domain != "remoteroles.example", domain).alias("domain"))
    return joins.propagate_unique(rows, "k", "domain").select("row_id", "domain")


@query(
    "WITH o AS (SELECT id, max(title) AS title, max(updated_at) AS updated_at, max(location.name) AS place FROM greenhouse_jobs WHERE batch_id <= 10 AND id IS NOT NULL GROUP BY id), "
    "n AS (SELECT id, max(title) AS title, max(updated_at) AS updated_at, max(location.name) AS place FROM greenhouse_jobs WHERE batch_id > 10 AND id IS NOT NULL GROUP BY id), "
    "j AS (SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'missing' WHEN o.id IS NULL THEN 'new' ELSE 'both' END AS c, "
    "concat_ws(',', CASE WHEN o.title IS DISTINCT FROM n.title THEN 'title' END, CASE WHEN o.updated_at IS DISTINCT FROM n.updated_at THEN 'updated_at' END, CASE WHEN o.place IS DISTINCT FROM n.place THEN 'place' END) AS f FROM o FULL OUTER JOIN n ON o.id = n.id) "
    "SELECT id, CASE WHEN c = 'both' THEN 'changed' ELSE c END AS change, CASE WHEN c = 'both' THEN f ELSE '' END AS changed_fields FROM j WHERE c <> 'both' OR f <> ''"
)
def q_manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "greenhouse_jobs").filter("id is not null")
    version = lambda when: jobs.filter(when).groupBy("id").agg(F.max("title").alias("title"), F.max("updated_at").alias("updated_at"), F.max("location.name").alias("place"))
    return joins.compare(version("batch_id <= 10"), version("batch_id > 10"), "id", ["title", "updated_at", "place"])


@query(
    f"WITH r AS (SELECT k, count(DISTINCT identifier) AS matches, min(identifier) AS i FROM (SELECT {_NORM.format('company_name')} AS k, identifier FROM boards_final) WHERE k <> '' GROUP BY k) "
    f"SELECT c.row_id, coalesce(r.matches, 0) AS matches, CASE WHEN r.matches = 1 THEN r.i END AS match FROM (SELECT row_id, {_NORM.format('Company')} AS k FROM crm_companies) c LEFT JOIN r USING (k)"
)
def q_unambiguous_matches(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "crm_companies").select("row_id", names.normalize_text(F.col("Company")).alias("k"))
    right = table(spark, d, "boards_final").select("identifier", names.normalize_text(F.col("company_name")).alias("k")).filter("k <> ''")
    return joins.match_unambiguous(left, right, "k", "identifier").select("row_id", "matches", "match")


@query(f"WITH e AS (SELECT {_NORM.format('company')} AS k, sha256(substring(description, 1, 20000)) AS p, min({_HOST.format('url')}) AS h FROM sources WHERE url LIKE '%://%' AND description IS NOT NULL GROUP BY ALL) SELECT k, count(DISTINCT h) AS hosts FROM e WHERE k <> '' GROUP BY k HAVING count(DISTINCT h) >= 2")
def q_independent_witnesses(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "sources").filter("url like '%://%' and description is not null")
    rows = src.select(names.normalize_text(F.col("company")).alias("k"), "description", urls.url_host(F.col("url")).alias("host")).filter("k <> ''")
    return joins.enough_witnesses(rows, "k", "description", "host", 2)


_NAME = "trim(regexp_replace(" + _WORDS + ", '( (" + names.LEGAL_FORMS + "))+$', ''))"


@query(
    f"WITH a AS (SELECT DISTINCT {_NAME.format('Company')} AS x FROM crm_companies), b AS (SELECT DISTINCT {_NAME.format('company_name')} AS y FROM boards_final), "
    "p AS (SELECT x, y, list_distinct(string_split(x, ' ')) AS p, list_distinct(string_split(y, ' ')) AS q FROM a JOIN b ON string_split(x, ' ')[1] = string_split(y, ' ')[1] WHERE x <> '' AND y <> ''), "
    "s AS (SELECT *, len(list_intersect(p, q)) AS i FROM p) SELECT x, y, x = y OR (length(x) >= 5 AND contains(' ' || y || ' ', ' ' || x || ' ')) OR (length(y) >= 5 AND contains(' ' || x || ' ', ' ' || y || ' ')) OR i = len(p) OR i = len(q) OR i / (len(p) + len(q) - i) >= 0.6 AS compatible FROM s"
)
def q_compatible_names(spark: SparkSession, d: str) -> DataFrame:
    from jobloom.functions.similarity import compatible_without_letters

    head = lambda c: F.split(c, " ")[0]
    a = table(spark, d, "crm_companies").select(names.company_name(F.col("Company")).alias("x")).filter("x <> ''").distinct().withColumn("w", head("x"))
    b = table(spark, d, "boards_final").select(names.company_name(F.col("company_name")).alias("y")).filter("y <> ''").distinct().withColumn("w", head("y"))
    return a.join(b, "w").select("x", "y", compatible_without_letters(F.col("x"), F.col("y")).alias("compatible"))


@query()
def q_all_compatible_names(spark: SparkSession, d: str) -> DataFrame:
    """All compatible pairs, whatever their first words; q_compatible_names and its SQL compare names with one first word by words only."""
    left = table(spark, d, "crm_companies").select(F.col("Company").alias("x"))
    return joins.compatible_pairs(left, table(spark, d, "boards_final").select(F.col("company_name").alias("y")))


@query(
    "WITH w(i, w) AS (VALUES (0, 7), (1, 30)), v(i, v) AS (VALUES (0, ''), (1, 'remote')) SELECT w.w AS \"window\", v.v AS variant, canonical_title, CASE WHEN v.v = '' THEN canonical_title ELSE canonical_title || ' ' || v.v END AS query FROM role_catalog, w, v ORDER BY w.i, v.i, role_id LIMIT 100"
)
def q_query_portfolio(spark: SparkSession, d: str) -> DataFrame:
    return ranking.query_portfolio(table(spark, d, "role_catalog"), "canonical_title", "role_id", ["", "remote"], [7, 30], 100)


# ---------------------------------------------------------------- ranking


_TITLE_WORDS = "list_filter(string_split({0}, ' '), lambda x: x <> '')"


@query(
    f"WITH u AS (SELECT row_id, unnest(list_distinct({_TITLE_WORDS.format(_WORDS.format('position'))})) AS w FROM sources), "
    f"e AS (SELECT role_id, len(ws) AS n, unnest(ws) AS w FROM (SELECT role_id, list_distinct({_TITLE_WORDS.format(_WORDS.format('canonical_title'))}) AS ws FROM role_catalog)), "
    "s AS (SELECT row_id, role_id, n, count(*) AS shared FROM u JOIN e USING (w) GROUP BY ALL) "
    "SELECT row_id, role_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY shared DESC, n, role_id) AS rn FROM s) WHERE rn = 1"
)
def q_best_role(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "sources").select("row_id", names.word_set(names.ascii_words(F.col("position"))).alias("uw"))
    entries = table(spark, d, "role_catalog").select("role_id", F.col("role_id").alias("ordinal"), names.word_set(names.ascii_words(F.col("canonical_title"))).alias("ew"))
    return ranking.best_match(units, "row_id", "uw", entries, "role_id", "ew", "ordinal")


@query(f"SELECT k AS company, row_id, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ingested_at DESC, row_id) AS rn FROM (SELECT {_NORM.format('company')} AS k, row_id, ingested_at FROM sources)) WHERE rn = 1")
def q_latest_per_company(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sources").select(names.normalize_text(F.col("company")).alias("company"), "row_id", "ingested_at")
    return dedup.first_per_key(rows, ["company"], [-_ntz_us("ingested_at"), F.col("row_id")]).select("company", "row_id", "ingested_at")


@query(
    "SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3"
)
def q_top_orders_per_customer(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.top_per_group(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query(
    f"WITH m AS ({_CASCADE_SQL}), c AS (SELECT reason, source_company, count(*) AS n FROM m WHERE reason IS NOT NULL AND source_company IS NOT NULL GROUP BY ALL) "
    "SELECT reason, source_company AS company, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY n DESC, source_company) AS rank FROM c) WHERE rank <= 10"
)
def q_top_companies_per_reason(spark: SparkSession, d: str) -> DataFrame:
    marked = rules.cascade(table(spark, d, "sources"), _cascade_rules()).filter("reason is not null and company is not null")
    counts = marked.groupBy("reason", "company").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_per_group(counts, ["reason"], [F.desc("n"), F.asc("company")], 10)


@query(
    "WITH t AS (SELECT role_id, function_bucket, row_number() OVER (PARTITION BY function_bucket ORDER BY length(canonical_title) DESC, role_id) AS turn FROM role_catalog), "
    "g AS (SELECT function_bucket, row_number() OVER (ORDER BY length(canonical_title) DESC, role_id) AS group_rank FROM role_catalog JOIN t USING (role_id, function_bucket) WHERE turn = 1) "
    "SELECT role_id, turn, group_rank FROM t JOIN g USING (function_bucket)"
)
def q_round_robin_roles(spark: SparkSession, d: str) -> DataFrame:
    roles = table(spark, d, "role_catalog")
    order = [F.desc(F.length("canonical_title")), F.asc("role_id")]
    return ranking.interleave(roles, "function_bucket", order).select("role_id", "turn", "group_rank")


@query("SELECT row_id, CAST(CAST('0x' || substring(sha256(key), 1, 16) AS UBIGINT) % 7 AS INT) AS slot FROM boards_final")
def q_hash_slots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "boards_final").select("row_id", ranking.hash_slot(F.col("key"), 7).alias("slot"))


@query("SELECT row_id, sha256(coalesce(provider, '') || '|' || coalesce(identifier, '')) AS digest FROM boards_final ORDER BY digest, provider, identifier LIMIT 40")
def q_stable_sample(spark: SparkSession, d: str) -> DataFrame:
    boards = table(spark, d, "boards_final").groupBy("provider", "identifier").agg(F.min("row_id").alias("row_id"))
    return ranking.stable_sample(boards, ["provider", "identifier"], 40).select("row_id", "digest")


SQL["q_stable_sample"] = "SELECT min(row_id) AS row_id, sha256(coalesce(provider, '') || '|' || coalesce(identifier, '')) AS digest FROM boards_final GROUP BY provider, identifier ORDER BY digest LIMIT 40"


@query(
    "WITH r AS (SELECT CAST(ts AS DATE) AS run, CAST(count(*) * 1000 AS BIGINT) AS bytes, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS INT) AS age FROM events GROUP BY ALL), "
    "n AS (SELECT *, row_number() OVER (ORDER BY run DESC) AS k, sum(bytes) OVER (ORDER BY run DESC ROWS UNBOUNDED PRECEDING) AS s, sum(bytes) OVER () AS total FROM r) "
    "SELECT run, bytes, age, CASE WHEN age > 25 THEN 'age' WHEN k > 20 THEN 'count' WHEN s > 400000 THEN 'bytes' END AS removed_for FROM n"
)
def q_retention(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("ts")
    runs = table(spark, d, "events").groupBy(day.alias("run")).agg((F.count(F.lit(1)) * 1000).alias("bytes"))
    return ranking.retention(runs.withColumn("age", F.datediff(F.lit("2024-01-31").cast("date"), "run")), "run", "bytes", "age", 20, 25, 400_000)


@query(
    "WITH u AS (SELECT row_id, last_job_count, CASE WHEN confidence IS NULL THEN 1 ELSE 2 END AS p FROM boards_final), o AS (SELECT * FROM u WHERE p = 1 ORDER BY last_job_count DESC NULLS LAST, row_id LIMIT 30) "
    "SELECT row_id, p FROM (SELECT * FROM o UNION ALL SELECT * FROM u WHERE p <> 1) ORDER BY p, last_job_count DESC NULLS LAST, row_id LIMIT 150"
)
def q_capped_schedule(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "boards_final").select("row_id", "last_job_count", F.when(F.col("confidence").isNull(), 1).otherwise(2).alias("p"))
    return ranking.capped_schedule(units, "p", [F.desc_nulls_last("last_job_count"), F.asc("row_id")], 1, 30, 150).select("row_id", "p")


# ---------------------------------------------------------------- identity and duplicates


def _identified(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "sources")
    key, strength = dedup.identity_ladder(F.col("id"), urls.apply_url(F.col("url")), [F.lit("feed"), F.col("company"), F.col("position"), F.col("location")])
    return src.select("row_id", "batch_id", "company", "tags", key.alias("key"), strength.alias("strength"))


_IDENTITY = (
    f"(SELECT row_id, batch_id, company, tags, CASE WHEN trim(id) <> '' THEN 'id:' || trim(id) WHEN u IS NOT NULL THEN 'url:' || u ELSE 'digest:' || substring(sha256(lower(concat_ws('|', 'feed', coalesce(company, ''), coalesce(position, ''), coalesce(location, '')))), 1, 32) END AS key, "
    f"CASE WHEN trim(id) <> '' THEN 'id' WHEN u IS NOT NULL THEN 'url' ELSE 'digest' END AS strength FROM (SELECT *, {_APPLY.format(_BARE)} AS u FROM sources))"
)


@query(f"SELECT strength, count(*) AS n_rows, count(DISTINCT key) AS n_unique, count(*) - count(DISTINCT key) AS n_duplicates FROM {_IDENTITY} GROUP BY strength")
def q_identity_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return metrics.uniqueness(_identified(spark, d), "key", "strength")


@query(
    f"WITH i AS {_IDENTITY}, s AS (SELECT DISTINCT key FROM i WHERE batch_id <= 15), r AS (SELECT i.*, row_number() OVER (PARTITION BY i.key ORDER BY row_id) AS rn, s.key IS NOT NULL AS seen FROM i LEFT JOIN s ON i.key = s.key WHERE batch_id > 15) "
    "SELECT CASE WHEN seen THEN 'seen' WHEN rn > 1 THEN 'duplicate' ELSE 'kept' END AS disposition, count(*) AS n FROM r GROUP BY 1"
)
def q_run_dispositions(spark: SparkSession, d: str) -> DataFrame:
    rows = _identified(spark, d)
    marked = dedup.dispositions(rows.filter("batch_id > 15"), "key", "row_id", rows.filter("batch_id <= 15").select("key"))
    return marked.groupBy("disposition").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH i AS {_IDENTITY}, n AS (SELECT DISTINCT key FROM i WHERE batch_id > 15), s AS (SELECT DISTINCT key FROM i WHERE batch_id <= 15) "
    "SELECT (SELECT count(*) FROM i WHERE batch_id > 15) AS gross, count(*) AS n_unique, count(s.key) AS previously_seen, count(*) - count(s.key) AS incremental FROM n LEFT JOIN s USING (key)"
)
def q_baselines(spark: SparkSession, d: str) -> DataFrame:
    rows = _identified(spark, d)
    return metrics.baselines(rows.filter("batch_id > 15"), "key", rows.filter("batch_id <= 15").select("key"))


@query()
def q_sequential_merge(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the feed folded one after the other into postings; order decides, so SQL has no counterpart."""
    src = table(spark, d, "sources")
    title = names.ascii_words(F.col("position"))
    domain = urls.company_domain(F.col("url"))
    rows = src.withColumn("title", title).filter("title <> ''")
    named = lambda kind, c: F.transform(F.filter(F.array(c), lambda x: x.isNotNull() & (x != "")), lambda x: F.concat(F.lit(f"{kind}:"), x, F.lit("|"), F.col("title")))
    keys = F.concat(named("name", names.normalize_text(F.col("company"))), named("domain", F.when(domain != "remoteroles.example", domain)), named("id", posting_id(F.col("id"))))
    strength = F.when(F.col("url").isNotNull(), 2).otherwise(0) + F.when(F.length(F.coalesce("description", F.lit(""))) > 300, 1).otherwise(0)
    merged = dedup.sequential_merge(rows.select("title", F.col("row_id").alias("ord"), "row_id", keys.alias("keys"), strength.alias("strength"), F.coalesce("company", F.lit("")).alias("source")))
    return merged.select("winner", F.size("members").alias("n_members"), F.size("sources").alias("n_sources"))


@query(
    "SELECT k, row_id, strength FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY strength DESC, round, row_id) AS rn FROM "
    "(SELECT board_identifier AS k, row_id, length(title) AS strength, 0 AS round FROM greenhouse_jobs UNION ALL SELECT board_identifier, row_id, length(title), 1 FROM ashby_jobs)) WHERE rn = 1"
)
def q_union_prefer_stronger(spark: SparkSession, d: str) -> DataFrame:
    rounds = [table(spark, d, t).select(F.col("board_identifier").alias("k"), "row_id", F.length("title").alias("strength")) for t in ("greenhouse_jobs", "ashby_jobs")]
    return dedup.union_prefer_stronger(rounds, "k", F.coalesce("strength", F.lit(-1)), "row_id")


SQL["q_union_prefer_stronger"] = SQL["q_union_prefer_stronger"].replace("ORDER BY strength DESC,", "ORDER BY coalesce(strength, -1) DESC,")

# ---------------------------------------------------------------- accounting


@query(
    "WITH r AS (SELECT row_id, company IS NULL AS no_company, url IS NULL AS no_url, 'batch' || batch_id AS p, list_distinct(list_concat(coalesce(tags, []), ['batch' || batch_id])) AS all_of FROM sources), "
    "x AS (SELECT unnest(all_of) AS source, p, no_company, no_url FROM r) SELECT source, count(*) AS \"rows\", count(*) FILTER (source = p) AS as_primary, count(*) FILTER (no_company) AS no_company, count(*) FILTER (no_url) AS no_url FROM x WHERE source IS NOT NULL GROUP BY source"
)
def q_source_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sources").withColumn("batch", F.concat(F.lit("batch"), F.col("batch_id").cast("string")))
    return metrics.source_outcomes(rows, "batch", "tags", {"no_company": F.col("company").isNull(), "no_url": F.col("url").isNull()})


@query(
    "SELECT batch_id, count(*) AS entered, count(*) FILTER (r = 'no_id') AS no_id, count(*) FILTER (r = 'no_company') AS no_company, count(*) FILTER (coalesce(url IS NULL, false)) AS no_url, count(*) FILTER (coalesce(description IS NULL, false)) AS no_text, count(*) FILTER (r IS NULL) AS kept "
    "FROM (SELECT *, CASE WHEN id IS NULL THEN 'no_id' WHEN company IS NULL THEN 'no_company' END AS r FROM sources) GROUP BY batch_id"
)
def q_discard_attribution(spark: SparkSession, d: str) -> DataFrame:
    removing = [("no_id", F.col("id").isNull()), ("no_company", F.col("company").isNull())]
    annotating = [("no_url", F.col("url").isNull()), ("no_text", F.col("description").isNull())]
    return metrics.attribute_discards(table(spark, d, "sources"), "batch_id", removing, annotating)


@query("SELECT provider, sum(t) AS denominator FROM (SELECT provider, identifier, max(last_job_count) AS t FROM boards_final GROUP BY ALL) GROUP BY provider")
def q_denominators(spark: SparkSession, d: str) -> DataFrame:
    return metrics.denominator(table(spark, d, "boards_final"), "provider", "identifier", "last_job_count")


_COVERED = " UNION ALL ".join(f"SELECT {_WORDS.format(c)} AS title, '{t}' AS source FROM {t}" for t, c in (("greenhouse_jobs", "title"), ("ashby_jobs", "title"), ("workday_postings", "title")))


@query(f"WITH p AS ({_COVERED}), b AS (SELECT title, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM p GROUP BY title) SELECT t.title, coalesce(n, 0) AS n, coalesce(sources, '') AS sources FROM (SELECT {_WORDS.format('canonical_title')} AS title FROM role_catalog) t LEFT JOIN b USING (title)")
def q_title_coverage(spark: SparkSession, d: str) -> DataFrame:
    posts = None
    for t in ("greenhouse_jobs", "ashby_jobs", "workday_postings"):
        part = table(spark, d, t).select(names.ascii_words(F.col("title")).alias("title"), F.lit(t).alias("source"))
        posts = part if posts is None else posts.unionByName(part)
    targets = table(spark, d, "role_catalog").select(names.ascii_words(F.col("canonical_title")).alias("title"))
    return metrics.coverage(targets, "title", posts, "source")


@query(
    "SELECT batch_id, min(nullif(trim(date), '')) AS first_date, max(nullif(trim(date), '')) AS last_date, count(*) FILTER (date IS NULL) AS undated FROM sources GROUP BY batch_id"
)
def q_posted_bounds(spark: SparkSession, d: str) -> DataFrame:
    stated = F.nullif(F.trim("date"), F.lit(""))
    return table(spark, d, "sources").groupBy("batch_id").agg(F.min(stated).alias("first_date"), F.max(stated).alias("last_date"), F.count_if(F.col("date").isNull()).alias("undated"))


@query(
    f"WITH c AS (SELECT DISTINCT batch_id, {_NORM.format('company')} AS k FROM sources), f AS (SELECT k, min(batch_id) AS b FROM c WHERE k <> '' GROUP BY k) SELECT c.batch_id, count(*) AS observed, count(*) FILTER (f.b = c.batch_id) AS new_companies, count(*) FILTER (f.b < c.batch_id) AS previous_companies FROM c JOIN f USING (k) GROUP BY c.batch_id"
)
def q_fresh_companies(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "sources").select("batch_id", names.normalize_text(F.col("company")).alias("k")).filter("k <> ''").distinct()
    first = seen.groupBy("k").agg(F.min("batch_id").alias("b"))
    flags = seen.join(first, "k")
    return flags.groupBy("batch_id").agg(F.count(F.lit(1)).alias("observed"), F.count_if(F.col("b") == F.col("batch_id")).alias("new_companies"), F.count_if(F.col("b") < F.col("batch_id")).alias("previous_companies"))


@query(
    "SELECT event_type, first, last, CASE WHEN last > first * 1.1 THEN 'growing' WHEN last < first * 0.9 THEN 'declining' ELSE 'flat' END AS trend FROM "
    "(SELECT event_type, arg_min(n, d) AS first, arg_max(n, d) AS last FROM (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type)"
)
def q_depletion(spark: SparkSession, d: str) -> DataFrame:
    series = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return metrics.depletion(series, "event_type", "d", "n")


_STAGES = (
    "(SELECT 1 AS ord, 'orders' AS stage, 'order' AS unit, count(*) AS entered, count(*) FILTER (o_orderstatus = 'O') AS passed FROM orders UNION ALL "
    "SELECT 2, 'priced', 'order', count(*), count(*) FILTER (o_totalprice > 100000) FROM orders WHERE o_orderstatus = 'O' UNION ALL "
    "SELECT 3, 'lines', 'line', count(*), count(*) FILTER (l_returnflag = 'N') FROM lineitem)"
)


@query(f"SELECT ord, stage, unit, entered, passed, entered - passed AS lost, round(passed / first_value(entered) OVER (PARTITION BY unit ORDER BY ord), 6) AS survival FROM {_STAGES}")
def q_waterfall(spark: SparkSession, d: str) -> DataFrame:
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    stage = lambda df, ord_, name, unit, passed: df.agg(F.count(F.lit(1)).alias("entered"), F.count_if(passed).alias("passed")).select(F.lit(ord_).alias("ord"), F.lit(name).alias("stage"), F.lit(unit).alias("unit"), "entered", "passed")
    stages = (
        stage(orders, 1, "orders", "order", F.col("o_orderstatus") == "O")
        .unionByName(stage(orders.filter("o_orderstatus = 'O'"), 2, "priced", "order", F.col("o_totalprice") > 100_000))
        .unionByName(stage(lines, 3, "lines", "line", F.col("l_returnflag") == "N"))
    )
    return metrics.waterfall(stages)


@query(
    f"WITH t AS (SELECT count(*) AS entered, count(*) FILTER (reason IS NOT NULL) AS rejected, count(*) FILTER (reason IS NULL) AS passed FROM ({_CASCADE_SQL})), i AS (SELECT count(*) AS r, count(DISTINCT key) AS u FROM {_IDENTITY}) "
    "SELECT 'entered' AS \"check\", entered AS lhs, passed + rejected AS rhs, entered - passed - rejected AS delta FROM t UNION ALL SELECT 'unique', u, u, 0 FROM i"
)
def q_reconciliation(spark: SparkSession, d: str) -> DataFrame:
    marked = rules.cascade(table(spark, d, "sources"), _cascade_rules())
    totals = marked.agg(F.count(F.lit(1)).alias("entered"), F.count_if(F.col("reason").isNotNull()).alias("rejected"), F.count_if(F.col("reason").isNull()).alias("passed"))
    unique = metrics.uniqueness(_identified(spark, d), "key", "strength").agg(F.sum("n_rows").alias("r"), F.sum("n_unique").alias("u"), F.sum("n_duplicates").alias("x"))
    first = metrics.reconcile(totals, {"entered": (F.col("entered"), F.col("passed") + F.col("rejected"))})
    # Different keys counted directly against rows less the duplicates that grouping by strength and key found.
    direct = _identified(spark, d).agg(F.count_distinct("key").alias("direct"))
    return first.unionByName(metrics.reconcile(unique.join(direct, F.lit(True)), {"unique": (F.col("direct"), F.col("r") - F.col("x"))}))


@query(
    "WITH b AS (SELECT l_suppkey, l_partkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_discount >= 0.08) AS discounted FROM lineitem GROUP BY ALL) "
    "SELECT l_suppkey, count(*) AS n_inner, count(*) FILTER (returned) AS returned, count(*) FILTER (discounted) AS discounted FROM b GROUP BY l_suppkey HAVING count(*) >= 2"
)
def q_two_level_flags(spark: SparkSession, d: str) -> DataFrame:
    flags = {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") >= 0.08}
    return metrics.two_level(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", flags)


_CONFUSED = "SELECT coalesce(employmentType, '') AS segment, CASE WHEN workplaceType IS NULL THEN NULL ELSE workplaceType = 'Remote' END AS p, isRemote AS g FROM ashby_jobs"


@query(
    f"SELECT segment, tp, fp, fn, tn, abstain, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM (SELECT segment, count(*) FILTER (p AND g) AS tp, count(*) FILTER (p AND NOT g) AS fp, count(*) FILTER (NOT p AND g) AS fn, count(*) FILTER (NOT p AND NOT g) AS tn, count(*) FILTER (p IS NULL) AS abstain FROM ({_CONFUSED}) GROUP BY segment)"
)
def q_confusion(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "ashby_jobs").withColumn("segment", F.coalesce("employmentType", F.lit("")))
    return metrics.confusion(rows, "segment", F.col("workplaceType") == "Remote", F.col("isRemote"))


@query(
    "SELECT CASE WHEN NOT o AND n THEN 'recovered' WHEN o AND NOT n THEN 'lost' WHEN o THEN 'kept' ELSE 'rejected' END AS change, count(*) AS n FROM (SELECT l_quantity < 20 AS o, l_quantity < 25 AND l_discount < 0.07 AS n FROM lineitem) GROUP BY 1"
)
def q_policy_difference(spark: SparkSession, d: str) -> DataFrame:
    return metrics.policy_difference(table(spark, d, "lineitem"), F.col("l_quantity") < 20, (F.col("l_quantity") < 25) & (F.col("l_discount") < 0.07))


_RANKS = {"PASS": 0, "NEEDS_CHECK": 1, "REROUTE": 2, "UNVERIFIED": 3, "REJECT": 4}


@query(
    "WITH g AS (SELECT l_orderkey AS k, l_linenumber AS i, CASE l_returnflag WHEN 'R' THEN 'REJECT' WHEN 'A' THEN 'NEEDS_CHECK' ELSE 'PASS' END AS state, 'line' || l_linenumber AS gate FROM lineitem), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CASE state WHEN 'REJECT' THEN 4 WHEN 'NEEDS_CHECK' THEN 1 ELSE 0 END DESC, i) AS rn FROM g) SELECT k AS l_orderkey, state, gate FROM r WHERE rn = 1"
)
def q_gate_decisions(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    verdict = F.when(F.col("l_returnflag") == "R", "REJECT").when(F.col("l_returnflag") == "A", "NEEDS_CHECK").otherwise("PASS")
    gate = F.struct(F.col("l_linenumber").alias("i"), F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("gate"), verdict.alias("state"), F.col("l_returnflag").alias("reason"))
    gates = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(gate)).alias("gates"))
    decided = gates.withColumn("v", rules.decide(F.transform("gates", lambda g: F.struct(g["gate"].alias("gate"), g["state"].alias("state"), g["reason"].alias("reason"))), _RANKS))
    return decided.select("l_orderkey", "v.state", "v.gate")


# ---------------------------------------------------------------- state


@query("SELECT user_id, min(ts) AS first_seen FROM events GROUP BY user_id HAVING date_diff('day', CAST(min(ts) AS DATE), DATE '2024-01-30') <= 28")
def q_seen_state(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    early = state.first_seen(None, events.filter("ts < timestamp_ntz'2024-01-15'"), "user_id", "ts")
    return state.first_seen(early, events.filter("ts >= timestamp_ntz'2024-01-15'"), "user_id", "ts", 28, F.lit("2024-01-30").cast("date"))


@query(
    "WITH e AS (SELECT event_type, max(ts) AS high, min(ts) AS low FROM events GROUP BY event_type) SELECT event_type, high, low, string_agg(DISTINCT CASE WHEN ts = high THEN CAST(event_id AS VARCHAR) END, ',' ORDER BY CASE WHEN ts = high THEN CAST(event_id AS VARCHAR) END) AS high_ids, "
    "string_agg(DISTINCT CASE WHEN ts = low THEN CAST(event_id AS VARCHAR) END, ',' ORDER BY CASE WHEN ts = low THEN CAST(event_id AS VARCHAR) END) AS low_ids FROM events JOIN e USING (event_type) GROUP BY ALL"
)
def q_cursor_edges(spark: SparkSession, d: str) -> DataFrame:
    return state.cursor(table(spark, d, "events"), "event_type", "ts", "event_id")


@query(
    "WITH o AS (SELECT DISTINCT board_identifier AS b, id FROM greenhouse_jobs WHERE batch_id <= 10 AND id IS NOT NULL), n AS (SELECT DISTINCT board_identifier AS b, id FROM greenhouse_jobs WHERE batch_id > 10 AND id IS NOT NULL) "
    "SELECT coalesce(o.b, n.b) AS board_identifier, count(*) FILTER (o.id IS NULL) AS opened, count(*) FILTER (n.id IS NULL) AS closed FROM o FULL OUTER JOIN n ON o.b = n.b AND o.id = n.id GROUP BY 1 HAVING count(*) FILTER (o.id IS NULL OR n.id IS NULL) > 0"
)
def q_snapshot_changes(spark: SparkSession, d: str) -> DataFrame:
    jobs = table(spark, d, "greenhouse_jobs").filter("id is not null")
    return state.snapshot_changes(jobs.filter("batch_id <= 10"), jobs.filter("batch_id > 10"), "board_identifier", "id")


@query(
    "SELECT provider, identifier, company_name FROM (SELECT *, row_number() OVER (PARTITION BY provider, identifier ORDER BY CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END DESC, row_id) AS rn FROM boards_final WHERE company_name IS NOT NULL) WHERE rn = 1"
)
def q_confident_names(spark: SparkSession, d: str) -> DataFrame:
    boards = table(spark, d, "boards_final").filter("company_name is not null").withColumn("k", F.concat_ws("\u0001", "provider", "identifier"))
    confidence = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).when(F.col("confidence") == "low", 1).otherwise(0)
    named = state.upsert_confident(boards, "k", "company_name", confidence, "row_id")
    return named.select(F.split("k", "\u0001")[0].alias("provider"), F.split("k", "\u0001")[1].alias("identifier"), "company_name")


@query("SELECT event_id, epoch_us(ts) + CASE WHEN k <= 0 THEN 1 ELSE least(48, CAST(pow(2, least(5, k)) AS INT)) END * 3600000000 AS due_us FROM (SELECT event_id, ts, event_id % 8 AS k FROM events)")
def q_retry_times(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("k", F.pmod("event_id", F.lit(8)))
    return events.select("event_id", ages.retry_at(_ntz_us("ts"), F.col("k")).alias("due_us"))


# ---------------------------------------------------------------- sources and streams


@query(
    "SELECT acquisition_source, count(*) AS n, count(*) FILTER (job_title = '') AS untitled, count(*) FILTER (job_location = '') AS unplaced, count(*) FILTER (job_is_remote) AS remote FROM ("
    "SELECT 'remoteok' AS acquisition_source, coalesce(position, '') AS job_title, coalesce(location, '') AS job_location, true AS job_is_remote FROM sources WHERE id IS NOT NULL UNION ALL "
    "SELECT 'greenhouse', coalesce(title, ''), coalesce(location.name, ''), NULL FROM greenhouse_jobs UNION ALL "
    "SELECT 'ashby', coalesce(title, ''), coalesce(location, ''), isRemote FROM ashby_jobs WHERE isListed IS DISTINCT FROM false UNION ALL "
    "SELECT 'lever', coalesce(text, ''), coalesce(categories.location, ''), lower(workplaceType) = 'remote' FROM lever_postings UNION ALL "
    "SELECT 'smartrecruiters', coalesce(name, ''), concat_ws(', ', nullif(location.city, ''), nullif(location.region, ''), nullif(location.country, '')), location.remote FROM smartrecruiters_postings WHERE active IS DISTINCT FROM false UNION ALL "
    "SELECT 'workday', coalesce(title, ''), '', NULL FROM workday_postings) GROUP BY acquisition_source"
)
def q_canonical_postings(spark: SparkSession, d: str) -> DataFrame:
    """Six tables through their providers' expressions as one table of canonical postings, counted."""
    from jobloom.sources.providers import PROVIDERS, Provider, canonical

    every = None
    for name, t in (("remoteok", "sources"), ("greenhouse", "greenhouse_jobs"), ("ashby", "ashby_jobs"), ("lever", "lever_postings"), ("smartrecruiters", "smartrecruiters_postings"), ("workday", "workday_postings")):
        p = PROVIDERS[name]
        lane = canonical(table(spark, d, t), name, Provider(p.schema, "", p.columns, p.keep, p.html))
        every = lane if every is None else every.unionByName(lane)
    return every.groupBy("acquisition_source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("job_title") == "").alias("untitled"), F.count_if(F.col("job_location") == "").alias("unplaced"), F.count_if(F.coalesce("job_is_remote", F.lit(False))).alias("remote")
    )


@query("SELECT user_id, min(epoch_us(ts)) AS at_us FROM events GROUP BY user_id")
def q_stream_first_sights(spark: SparkSession, d: str) -> DataFrame:
    """The stream of events through keyed state; its result equals the batch aggregate."""
    from jobloom.streaming.flows import first_sights, read_stream, run_to_end

    return run_to_end(first_sights(read_stream(spark, d, "events.parquet"), "user_id", "ts", 365), "first-sights")
