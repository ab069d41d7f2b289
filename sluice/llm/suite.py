"""Registered queries of the corpus operators, with DuckDB oracles where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.fill_in_middle import fill_in_middle, restored
from sluice.llm.mixing import mix_sources
from sluice.llm.nb_svm import quality_scores
from sluice.llm.ngram_join import ngram_components
from sluice.llm.packing import pack_documents
from sluice.llm.paragraph_sketch import fingerprints
from sluice.llm.pii_surrogates import surrogate_pii
from sluice.llm.pitman_yor import language_scores
from sluice.llm.quality_rules import quality_rules
from sluice.llm.suffix_dedup import remove_repeats
from sluice.llm.target_resampling import resample
from sluice.llm.toxicity import toxicity
from sluice.llm.url_lists import filter_urls, host_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


@register("op1_ngram_jaccard_join")
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=4, pct=85)


@register("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@register("op10_pii_surrogates")
def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogate_pii(docs).select("doc_id", "n_entities", "text")


# Targets of the mix: domains by the source's number, languages and sources by fixed weights.
DOMAINS = ("web", "books", "code", "news")
DOMAIN_WEIGHTS = {"web": 4, "books": 3, "code": 2, "news": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 1}
MIX = {"budget_pct": 60, "max_epochs": 4, "seed": 17}


def source_number() -> Column:
    return F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT)"), F.lit(0))


def source_domain() -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), source_number() % len(DOMAINS) + 1)


def mix_weights(docs: DataFrame) -> DataFrame:
    """The target tree: a weight for each domain, language and source that the documents hold."""
    pick = lambda c, weights: sum((F.when(F.col(c) == k, v).otherwise(0) for k, v in weights.items()), F.lit(0))
    leaves = docs.select(source_domain().alias("domain"), "lang", "source").distinct()
    return leaves.select("domain", "lang", "source", pick("domain", DOMAIN_WEIGHTS).alias("domain_weight"),
                         F.greatest(pick("lang", LANG_WEIGHTS), F.lit(1)).alias("lang_weight"), (1 + source_number() % 3).alias("source_weight"))


def _fill_sql(name: str, nodes: str, parents: str, order: str, weight: str) -> str:
    """Water filling of one level, as CTEs that end in ``name`` (columns of ``nodes`` with ``given``)."""
    part = f"PARTITION BY {parents}" if parents else ""
    return f"""
{name}_1 AS (SELECT *, CASE WHEN cap > 0 THEN {weight} ELSE 0 END AS w FROM {nodes}),
{name}_2 AS (SELECT *, CASE WHEN w > 0 THEN cap::DOUBLE / w ELSE 'inf'::DOUBLE END AS ratio FROM {name}_1),
{name}_3 AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
  coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before, sum(w) OVER ({part}) AS w_all
  FROM {name}_2 WINDOW o AS ({part} ORDER BY ratio, {order})),
{name}_4 AS (SELECT *, w > 0 AND cap * (w_all - w_before) <= w * (amount - cap_before) AS is_full FROM {name}_3),
{name}_5 AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({part}) AS cap_full,
  sum(CASE WHEN is_full THEN w ELSE 0 END) OVER ({part}) AS w_full FROM {name}_4),
{name} AS (SELECT *, CASE WHEN w = 0 THEN 0 WHEN is_full THEN cap ELSE (w * (amount - cap_full)) // (w_all - w_full) END AS given FROM {name}_5)"""


def mix_sql(docs: str) -> str:
    """DuckDB SQL of the mix over a relation ``docs``: CTEs up to ``mixed(doc_id, domain, lang, source, n_tokens, epoch)``."""
    def cases(c: str, weights: dict[str, int], other: int) -> str:
        return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {other} END"
    number = r"coalesce(try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INTEGER), 0)"
    domain = f"CASE {number} % {len(DOMAINS)} " + " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DOMAINS)) + " END"
    return rf"""
tok AS (SELECT doc_id, {domain} AS domain, lang, source, {number} AS num,
  CAST(length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM {docs}),
leaf AS (SELECT domain, lang, source, any_value(num) AS num, CAST(sum(n_tokens) AS BIGINT) AS avail FROM tok GROUP BY ALL),
tree AS (SELECT *, avail * {MIX['max_epochs']} AS cap, {cases('domain', DOMAIN_WEIGHTS, 0)} AS dw,
  {cases('lang', LANG_WEIGHTS, 1)} AS lw, 1 + num % 3 AS sw FROM leaf),
dom0 AS (SELECT domain, CAST(sum(cap) AS BIGINT) AS cap, max(dw) AS dw, (SELECT CAST(sum(avail) AS BIGINT) * {MIX['budget_pct']} // 100 FROM leaf) AS amount
  FROM tree GROUP BY domain),{_fill_sql('dom', 'dom0', '', 'domain', 'dw')},
lang0 AS (SELECT t.domain, t.lang, CAST(sum(t.cap) AS BIGINT) AS cap, max(t.lw) AS lw, any_value(d.given) AS amount
  FROM tree t JOIN dom d ON t.domain IS NOT DISTINCT FROM d.domain GROUP BY t.domain, t.lang),{_fill_sql('lng', 'lang0', 'domain', 'lang', 'lw')},
src0 AS (SELECT t.*, l.given AS amount FROM tree t JOIN lng l ON t.domain IS NOT DISTINCT FROM l.domain AND t.lang IS NOT DISTINCT FROM l.lang),
{_fill_sql('src', 'src0', 'domain, lang', 'source', 'sw').lstrip()},
quota AS (SELECT domain, lang, source, avail, given // avail AS epochs, given % avail AS rest FROM src WHERE avail > 0),
placed AS (SELECT t.*, q.epochs, q.rest, md5('{MIX['seed']}:' || q.epochs || ':' || coalesce(CAST(t.doc_id AS VARCHAR), '')) AS ord_key
  FROM tok t JOIN quota q ON t.domain IS NOT DISTINCT FROM q.domain AND t.lang IS NOT DISTINCT FROM q.lang AND t.source IS NOT DISTINCT FROM q.source),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord_key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed),
mixed AS (SELECT doc_id, domain, lang, source, n_tokens,
  CAST(unnest(range(CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS epoch FROM run)"""


@register("op3_mix_sources", f"WITH {mix_sql('documents')} SELECT * FROM mixed")
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, mix_weights(docs), source_domain(), **MIX)


@register("op5_pack_documents")
def op5_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@register("op4_paragraph_sketch")
def op4_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def fetch_day(page_id: Column) -> Column:
    """Captures carry no time of their own: a day of 2024 by their id."""
    return F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(page_id, F.lit(360)).cast("int"))


def url_entries(pages: DataFrame) -> DataFrame:
    """A dated log of three lists over the sites that the pages hold: additions, removals, additions again."""
    site = F.regexp_extract(host_of(F.col("url")), r"([^.]+\.[^.]+\.[^.]+)$", 1)
    sites = pages.select(site.alias("site")).filter("site IS NOT NULL AND site <> ''").distinct()
    number = F.conv(F.substring(F.md5("site"), 1, 6), 16, 10).cast("int")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    n = sites.withColumn("num", number)
    entry = lambda where, name, pattern, action, since: n.filter(where).select(
        F.lit(name).alias("list"), pattern.alias("pattern"), F.lit(action).alias("action"), day(since).alias("since"))
    num = F.col("num")
    logs = [entry("site RLIKE 'pills|casino|adult|porn|bet|spam'", "spam", F.col("site"), "add", F.lit(0)),
            entry("num % 3 = 0", "ads", F.col("site"), "add", num % 200), entry("num % 3 = 0", "ads", F.col("site"), "remove", num % 200 + 60 + num % 50),
            entry("num % 6 = 0", "ads", F.col("site"), "add", num % 200 + 200),
            entry("num % 2 = 0", "paths", F.concat("site", F.lit("/de")), "add", num % 300),
            entry("num % 4 = 0", "paths", F.concat("site", F.lit("/de")), "remove", num % 300 + 20)]
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log)
    return out


@register("op7_url_lists", r"""
WITH cap AS (SELECT page_id, DATE '2024-01-01' + CAST(page_id % 360 AS INTEGER) AS fetched,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]*)', 1), '') AS segment FROM pages),
sites AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS site FROM cap WHERE host IS NOT NULL),
num AS (SELECT site, CAST('0x' || substr(md5(site), 1, 6) AS INTEGER) AS num FROM sites WHERE site <> ''),
entries AS (SELECT 'spam' AS list, site AS pattern, 'add' AS action, 0 AS d FROM num WHERE regexp_matches(site, 'pills|casino|adult|porn|bet|spam')
  UNION ALL SELECT 'ads', site, 'add', num % 200 FROM num WHERE num % 3 = 0
  UNION ALL SELECT 'ads', site, 'remove', num % 200 + 60 + num % 50 FROM num WHERE num % 3 = 0
  UNION ALL SELECT 'ads', site, 'add', num % 200 + 200 FROM num WHERE num % 6 = 0
  UNION ALL SELECT 'paths', site || '/de', 'add', num % 300 FROM num WHERE num % 2 = 0
  UNION ALL SELECT 'paths', site || '/de', 'remove', num % 300 + 20 FROM num WHERE num % 4 = 0),
dated AS (SELECT list, pattern, DATE '2024-01-01' + CAST(d AS INTEGER) AS since, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM dated),
hit AS (SELECT c.host, c.segment, c.fetched, s.list, s.pattern
  FROM (SELECT DISTINCT host, segment, fetched FROM cap WHERE host IS NOT NULL AND fetched IS NOT NULL) c JOIN spans s
  ON (c.host = split_part(s.pattern, '/', 1) OR ends_with(c.host, '.' || split_part(s.pattern, '/', 1)))
  AND (NOT contains(s.pattern, '/') OR lower(c.segment) = split_part(s.pattern, '/', 2))
  AND s.action = 'add' AND s.since <= c.fetched AND (s.until IS NULL OR c.fetched < s.until)),
verdict AS (SELECT host, segment, fetched, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
  min(CAST(1000 - length(pattern) AS VARCHAR) || pattern) AS best FROM hit GROUP BY ALL)
SELECT c.page_id, c.host, c.fetched, v.n IS NOT NULL AS blocked, coalesce(v.n, 0) AS n_entries, coalesce(v.lists, '') AS lists,
  substr(v.best, 4) AS pattern
FROM cap c LEFT JOIN verdict v ON c.host = v.host AND c.segment = v.segment AND c.fetched = v.fetched
""")
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("fetched", fetch_day(F.col("page_id")))
    return filter_urls(pages, url_entries(pages))


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


@register("op9_pitman_yor")
def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


@register("op11_fill_in_middle", r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
tok AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t, CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM doc),
cut AS (SELECT *, CAST(len(t) AS BIGINT) AS n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM tok),
part AS (SELECT doc_id, text, n, form, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:], '') AS suf FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM part
""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@register("op12_target_resampling", r"""
WITH crc_table AS (SELECT list(c ORDER BY i) AS entries FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
    lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
words AS (SELECT 'own' AS side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
  UNION ALL SELECT 'target', NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
bucketed AS (SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(CAST(length(hex(word)) / 2 AS BIGINT)),
    lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))), lambda c, byte: xor(c >> 8, entries[(xor(c, byte) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), crc_table),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 'own') AS s, count(*) FILTER (WHERE side = 'target') AS t FROM words JOIN bucketed USING (word) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM counts),
weighed AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN bucketed USING (word) JOIN gain USING (bucket) WHERE side = 'own' GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weighed w ON d.doc_id = w.doc_id),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN p.rank <= p.n * 10 // 100 THEN p.rank END AS rank FROM scored s LEFT JOIN places p USING (doc_id)
""")
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_nb_svm")
def op13_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
