"""A second mapping of the tables whose rows reach every branch of the name,
text, pair, lookup and monitor rules (A6, A18, B4-B8, B18, B21-B25, E4, G5,
H22-H24, I9, I10). Names, texts and scores follow from keys; every row of the
tables takes part."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import (ARTICLE_URL_PATTERNS, AUTHORITY_DOMAINS, BYLINE_PATTERNS, EVIDENCE_TIERS, NAV_PHRASES, NOISE_AUTHORS, NOISE_DOMAINS,
                      PRELIMINARY_NONE, PRELIMINARY_REASONS, RETRAIN_KEYWORDS, SUSPICIOUS_KEYWORDS, SUSPICIOUS_TLDS, SYNDICATION_MARKERS)
from ..functions.domains import is_authority, not_noise, suspicious_name, suspicious_name_retrain
from ..functions.text import is_syndicated
from ..operators.authors import author_memberships
from ..operators.hosting import host_memberships
from ..operators.lookup import preliminary
from ..operators.monitor import freshness, rate_trend, registration_feed_domains, run_timeline
from ..operators.pages import article_urls, bylines_col
from ..operators.registration import plan_lookups
from ..operators.similarity import classify_pairs
from ..operators.verdict import evidence_tier
from ..sources.tables import Tables
from . import mapping as M
from . import sql_mapping as S
from .q_lookup import _promo, _tld
from .q_signals import AUTHOR_SQL, HOST_LIVE_SQL, _hosting
from .q_similarity import SIM_CFG, _nav_sql
from .q_text import sql_suspicious_kw
from .registry import register


def _pick(values, index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _sql_pick(values, index: str) -> str:
    return f"[{', '.join(S.q(v) for v in values)}][({index}) % {len(values)} + 1]"


# ---------------------------------------------------------------- names

def names(t: Tables):
    """key, domain: listed outlets and noise sites, suspicious endings, keywords, hyphens, and plain names."""
    k, s = F.col("c_custkey"), F.lower("c_mktsegment")
    key = k.cast("string")
    domain = (F.when(k % 40 == 0, _pick(AUTHORITY_DOMAINS, F.floor(k / 40))).when(k % 40 == 1, _pick(NOISE_DOMAINS, F.floor(k / 40)))
              .when(k % 5 == 2, F.concat(s, F.lit("-news-"), key, _pick(SUSPICIOUS_TLDS, k)))
              .when(k % 5 == 3, F.concat(_pick(SUSPICIOUS_KEYWORDS + RETRAIN_KEYWORDS, k), key, F.lit(".com")))
              .when(k % 7 == 4, F.concat(F.lit("a-b-"), key, F.lit(".org"))).when(k % 7 == 5, F.concat(F.lit("plain"), key))
              .otherwise(F.concat(s, key, F.lit(".com"))))
    return t.customer.select(k.alias("key"), domain.alias("domain"))


NAMES_SQL = f"""
select c_custkey as key, case when c_custkey % 40 = 0 then {_sql_pick(AUTHORITY_DOMAINS, 'c_custkey // 40')}
  when c_custkey % 40 = 1 then {_sql_pick(NOISE_DOMAINS, 'c_custkey // 40')}
  when c_custkey % 5 = 2 then lower(c_mktsegment) || '-news-' || c_custkey || {_sql_pick(SUSPICIOUS_TLDS, 'c_custkey')}
  when c_custkey % 5 = 3 then {_sql_pick(SUSPICIOUS_KEYWORDS + RETRAIN_KEYWORDS, 'c_custkey')} || c_custkey || '.com'
  when c_custkey % 7 = 4 then 'a-b-' || c_custkey || '.org' when c_custkey % 7 = 5 then 'plain' || c_custkey
  else lower(c_mktsegment) || c_custkey || '.com' end as domain from customer
"""


@register("varied_name_rules", ops=("B4", "B5", "B6", "B7"), sql=f"""
select key, {S.sql_suspicious('domain')} as suspicious, {sql_suspicious_kw('domain', RETRAIN_KEYWORDS)} as suspicious_retrain,
  domain not in {S.in_list(NOISE_DOMAINS)} as not_noise, {S.sql_authority('domain')} as authority
from ({NAMES_SQL}) n
""")
def q_varied_name_rules(spark, sf_dir):
    return names(Tables(spark, sf_dir)).select("key", suspicious_name("domain").alias("suspicious"),
                                               suspicious_name_retrain("domain").alias("suspicious_retrain"),
                                               not_noise("domain").alias("not_noise"), is_authority("domain").alias("authority"))


@register("varied_registration_feed", ops=("A6", "B4"), sql=f"""
select domain from (select distinct lower(trim(domain)) as domain from ({NAMES_SQL}) n) x
where contains(domain, '.') and ({_tld('domain')} or length(domain) - length(replace(domain, '-', '')) >= 2)
order by domain limit 500
""")
def q_varied_registration_feed(spark, sf_dir):
    """The feed's own cap of 500 applies (sf0.01 has more than 300 such names)."""
    return registration_feed_domains(names(Tables(spark, sf_dir)))


#: Lookups already made today, and those a day allows.
USED, ALLOWED = 15, 75


@register("varied_lookup_plan", ops=("A18", "B4"), sql=f"""
with n as ({NAMES_SQL}), h as (select distinct domain from n where key % 3 <> 0 and domain not in (select domain from n where key % 3 = 0)),
l as (select domain from h where {S.sql_suspicious('domain')} order by domain limit {ALLOWED - USED})
select domain, 'lookup' as action from l union all select domain, 'heuristic' from h where domain not in (select domain from l)
""")
def q_varied_lookup_plan(spark, sf_dir):
    """Names of every third key are cached already; the rest of the day's budget decides."""
    n = names(Tables(spark, sf_dir))
    return plan_lookups(n.filter("key % 3 <> 0").select("domain").distinct(), n.filter("key % 3 = 0").select("domain").distinct(), USED, ALLOWED)


def _prelim_sql() -> str:
    whois = f"coalesce(whois_flagged, cast({S.sql_suspicious('domain')} as integer)) = 1"
    rules = ["coalesce(domain_age_days between 0 and 90, false)", _tld("domain"), _promo("domain"), whois]
    score = " + ".join(f"cast({r} as integer)" for r in rules)
    reasons = ", ".join(f"case when {r} then {S.q(t)} end" for r, t in zip(rules, PRELIMINARY_REASONS))
    return f"""
with r as (select domain, min(key) as key from ({NAMES_SQL}) n group by domain),
g as (select domain, cast(case when key % 4 <> 0 then key % 400 end as integer) as domain_age_days,
             cast(case when key % 4 <> 0 then cast(key % 11 = 0 as integer) end as integer) as whois_flagged from r)
select domain, cast({score} as integer) as score, case when {score} >= 3 then 'SYNTHETIC' when {score} >= 1 then 'REVIEW' else 'ORGANIC' end as verdict,
  case when {score} >= 3 then 0.74 when {score} >= 1 then 0.58 else 0.76 end::double as confidence,
  coalesce(nullif(concat_ws('; ', {reasons}), ''), {S.q(PRELIMINARY_NONE)}) as explanation
from g
"""


@register("varied_preliminary", ops=("B18", "B17"), sql=_prelim_sql())
def q_varied_preliminary(spark, sf_dir):
    """Name-and-age heuristic with registration records: ages up to 399 days, some flagged, a quarter unknown."""
    d = names(Tables(spark, sf_dir)).groupBy("domain").agg(F.min("key").alias("key"))
    known = F.col("key") % 4 != 0
    reg = d.select("domain", F.when(known, (F.col("key") % 400).cast("int")).alias("domain_age_days"),
                   F.when(known, (F.col("key") % 11 == 0).cast("int")).alias("whois_flagged"))
    return preliminary(d.select("domain"), reg).select("domain", "score", "verdict", "confidence", "explanation")


# ---------------------------------------------------------------- texts and pairs

def articles(t: Tables):
    """doc_id, domain, text, author: some outlets, syndication markers, navigation phrases, shared bylines."""
    i = F.col("doc_id")
    text = F.coalesce("text", F.lit(""))
    text = (F.when(i % 9 == 0, F.concat(F.lit("Story. "), F.upper(_pick(SYNDICATION_MARKERS, i)), F.lit(" "), text))
            .when(i % 4 == 1, F.concat(F.lit(" | ".join(NAV_PHRASES)), F.lit(" "), text)).otherwise(text))
    domain = F.when((i < len(AUTHORITY_DOMAINS)) & (i % 2 == 0), _pick(AUTHORITY_DOMAINS, i)).otherwise(M.dom("doc_id"))
    return t.documents.select("doc_id", domain.alias("domain"), text.alias("text"),
                              F.when(i % 3 != 0, F.concat(F.lit("Writer Number "), (i % 50).cast("string"))).alias("author"))


ARTICLES_SQL = f"""
select doc_id, case when doc_id < {len(AUTHORITY_DOMAINS)} and doc_id % 2 = 0 then {_sql_pick(AUTHORITY_DOMAINS, 'doc_id')} else 'd' || doc_id end as domain,
  case when doc_id % 9 = 0 then 'Story. ' || upper({_sql_pick(SYNDICATION_MARKERS, 'doc_id')}) || ' ' || coalesce(text, '')
       when doc_id % 4 = 1 then {S.q(' | '.join(NAV_PHRASES))} || ' ' || coalesce(text, '') else coalesce(text, '') end as text,
  case when doc_id % 3 <> 0 then 'Writer Number ' || (doc_id % 50) end as author from documents
"""


@register("varied_syndication", ops=("B8",), sql=f"""
select doc_id, {S.sql_syndicated('text')} as syndicated from ({ARTICLES_SQL}) a
""")
def q_varied_syndication(spark, sf_dir):
    return articles(Tables(spark, sf_dir)).select("doc_id", is_syndicated("text").alias("syndicated"))


STEPS = (1, 2, 50, 100)


def scored_pairs(a):
    """Pairs of articles some steps apart, with scores from .50 to .99."""
    left = a.select("doc_id", F.col("domain").alias("x"), F.explode(F.array(*[F.lit(s) for s in STEPS])).alias("step"))
    right = a.select(F.col("doc_id").alias("_to"), F.col("domain").alias("y"))
    j = left.join(right, F.col("doc_id") + F.col("step") == F.col("_to"))
    raw = F.lit(0.5) + F.pmod(F.col("doc_id") * 7 + F.col("step"), F.lit(50)) / 100.0
    both, one = is_authority("x") & is_authority("y"), is_authority("x") | is_authority("y")
    eff = F.when(both, raw * SIM_CFG.authority_pair_weight).when(one, raw * SIM_CFG.authority_mixed_weight).otherwise(raw)
    return j.select(F.least("x", "y").alias("domain_a"), F.greatest("x", "y").alias("domain_b"), F.round(raw, 2).alias("raw"), eff.alias("eff"))


SCORED_SQL = f"""
p0 as (select x.domain as xd, y.domain as yd, round(0.5 + ((x.doc_id * 7 + s.step) % 50) / 100.0, 2) as raw
       from a x, (select unnest([{', '.join(map(str, STEPS))}]) as step) s join a y on y.doc_id = x.doc_id + s.step),
p as (select least(xd, yd) as domain_a, greatest(xd, yd) as domain_b, cast(raw as double) as raw,
             cast(case when {S.sql_authority('xd')} and {S.sql_authority('yd')} then raw * {SIM_CFG.authority_pair_weight}
                  when {S.sql_authority('xd')} or {S.sql_authority('yd')} then raw * {SIM_CFG.authority_mixed_weight} else raw end as double) as eff from p0)
"""


@register("varied_edge_types", ops=("B21", "B22", "G5"), sql=f"""
with a as ({ARTICLES_SQL}), {SCORED_SQL},
f as (select domain, {S.sql_syndicated('text')} as synd, text, {S.sql_authority('domain')} as auth, lower(author) as author from a),
x as (select p.*, fa.synd or fb.synd as syn, fa.auth or fb.auth as au, fa.text as text_a, fb.text as text_b,
             case when fa.author is not null and fb.author is not null then fa.author = fb.author end as overlap
      from p join f fa on fa.domain = p.domain_a join f fb on fb.domain = p.domain_b),
y as (select *, ({' + '.join(f'cast(({m}) and ({n}) as integer)' for m, n in zip(_nav_sql('text_a'), _nav_sql('text_b')))}) as nav from x)
select domain_a, domain_b, round(raw, 4) as score, round(eff, 4) as effective, au as authority_discounted, syn as syndicated,
  case when syn then 'shared_journalistic' when raw >= 0.90 and coalesce(overlap, false) then 'structural_clone'
       when raw >= 0.75 and overlap = false then 'shared_journalistic' when raw >= 0.80 and nav >= 5 then 'structural_clone'
       when raw >= 0.65 then 'shared_journalistic' else 'topic_overlap' end as similarity_type
from y
""")
def q_varied_edge_types(spark, sf_dir):
    a = articles(Tables(spark, sf_dir))
    by = a.filter("author IS NOT NULL").select("domain", "author")
    return classify_pairs(scored_pairs(a), a.select("domain", "text"), by, SIM_CFG)


@register("varied_evidence", ops=("B23", "H23", "F1"), sql=f"""
with a as ({ARTICLES_SQL}), {SCORED_SQL},
x as (select domain, regexp_replace(substr(text, 1, 400), '^\\s+|\\s+$', '', 'g') as ex from a)
select domain_a, domain_b, raw as similarity, case when raw >= 0.85 then {S.q(EVIDENCE_TIERS[0])} when raw >= 0.75 then {S.q(EVIDENCE_TIERS[1])}
  else {S.q(EVIDENCE_TIERS[2])} end as tier, md5(xa.ex) as excerpt_a_md5, md5(xb.ex) as excerpt_b_md5
from p join x xa on xa.domain = domain_a join x xb on xb.domain = domain_b
""")
def q_varied_evidence(spark, sf_dir):
    """Evidence rows by falling similarity: pair, tier and both excerpts (compared by their md5)."""
    from ..functions.text import excerpt
    a = articles(Tables(spark, sf_dir))
    ex = a.select("domain", F.md5(F.encode(excerpt("text", 400), "UTF-8")).alias("m"))
    e = (scored_pairs(a).join(ex.select(F.col("domain").alias("domain_a"), F.col("m").alias("excerpt_a_md5")), "domain_a")
         .join(ex.select(F.col("domain").alias("domain_b"), F.col("m").alias("excerpt_b_md5")), "domain_b"))
    return (e.select("domain_a", "domain_b", F.col("raw").alias("similarity"), evidence_tier("raw").alias("tier"), "excerpt_a_md5", "excerpt_b_md5")
            .orderBy(F.desc("similarity"), "domain_a", "domain_b"))


@register("host_evidence", ops=("H24", "C7", "C8"), sql=HOST_LIVE_SQL + """
, m as (
  select domain, 'SAME_IP' as edge_type, case when is_cdn then k_ip_gate else k_ip end as group_key from s where hosting_flagged = 1
  union all
  select domain, 'SAME_ASN', case when is_cdn then k_asn_gate else k_asn end from s where hosting_flagged = 1),
g as (select edge_type, group_key, count(*) as members from m where group_key is not null group by 1, 2 having count(*) > 1)
select m.domain, m.edge_type, m.group_key, g.members from m join g on m.edge_type = g.edge_type and m.group_key = g.group_key
""")
def q_host_evidence(spark, sf_dir):
    """Hosting evidence: each flagged domain with the address or network it shares and how many share it."""
    return host_memberships(_hosting(spark, sf_dir)).select("domain", "edge_type", "group_key", "members")


@register("author_evidence", ops=("H24", "C13"), sql=AUTHOR_SQL + "select domain, author, author_domains as members from m")
def q_author_evidence(spark, sf_dir):
    """Author evidence: each domain with a byline that others carry too and on how many domains it stands."""
    return author_memberships(M.bylines(Tables(spark, sf_dir))).select("domain", "author", F.col("author_domains").alias("members"))


# ---------------------------------------------------------------- monitor

def monthly_runs(t: Tables):
    """A run per month of orders: a batch per order, synthetic where the order is finished; none in June and December."""
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    return (t.orders.groupBy(month.alias("ran_ts")).agg(F.count(F.lit(1)).cast("int").alias("batches"),
                                                       F.sum(((F.col("o_orderstatus") == "F") & (F.month("o_orderdate") % 6 != 0)).cast("int")).cast("int").alias("synthetic_batches"))
            .withColumn("ran_at", F.col("ran_ts")))


RUNS_SQL = """
select cast(date_trunc('month', o_orderdate) as timestamp) as ran_at, count(*) as batches,
       count(*) filter (where o_orderstatus = 'F' and month(o_orderdate) % 6 <> 0) as synthetic_batches from orders group by 1
"""


@register("varied_run_timeline", ops=("B24", "B25", "E3"), sql=f"""
with r as (select *, synthetic_batches / batches as rate from ({RUNS_SQL}) x)
select ran_at, 'Run ' || row_number() over (order by ran_at) as run, round(rate, 4) as synthetic_rate,
  case when rate >= 0.5 then 'HIGH' when rate > 0 then 'MED' else 'OK' end as chip,
  case when rate >= 0.5 then 'HIGH' when rate >= 0.25 then 'ELEVATED' else 'NORMAL' end as threat from r
""")
def q_varied_run_timeline(spark, sf_dir):
    return run_timeline(monthly_runs(Tables(spark, sf_dir))).select("ran_at", "run", "synthetic_rate", "chip", "threat")


@register("varied_run_trend", ops=("E4",), sql=f"""
with x as (select ran_at, round(synthetic_batches / batches, 4) as rate from ({RUNS_SQL}) r)
select arg_min(rate, ran_at) as first_rate, arg_max(rate, ran_at) as last_rate, count(*) as runs, round(arg_max(rate, ran_at) - arg_min(rate, ran_at), 4) as change,
  case when arg_max(rate, ran_at) > arg_min(rate, ran_at) then '↑' when arg_max(rate, ran_at) < arg_min(rate, ran_at) then '↓' else '→' end as arrow from x
""")
def q_varied_run_trend(spark, sf_dir):
    return rate_trend(monthly_runs(Tables(spark, sf_dir)))


@register("varied_freshness", ops=("B24",), sql="""
with l as (select user_id, max(ts) as last from events group by user_id), m as (select max(ts) as now from events)
select user_id, case when (epoch(now) - epoch(last)) / 3600.0 < 6 then 'fresh' when (epoch(now) - epoch(last)) / 3600.0 < 24 then 'recent' else 'stale' end as freshness
from l, m
""")
def q_varied_freshness(spark, sf_dir):
    """How fresh each source is at the time of the newest event."""
    e = Tables(spark, sf_dir).events.select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    now = e.agg(F.max("ts").alias("now")).select("now").scalar()
    last = e.groupBy("user_id").agg(F.max("ts").alias("last"))
    hours = (F.unix_micros(now) - F.unix_micros("last")) / 3.6e9
    return last.select("user_id", freshness(hours).alias("freshness"))


# ---------------------------------------------------------------- pages

def bylined(t: Tables):
    """Documents headed by a byline of one of the patterns, by a desk, or by none; some names twice."""
    i = F.col("doc_id")
    first, last = _pick(("Anna", "Boris", "Carla", "Dmitri", "Elena"), i), _pick(("Smith", "Jones", "Brown"), F.floor(i / 5))
    head = (F.when(i % 6 == 0, F.concat(F.lit("By "), first, F.lit(" "), last, F.lit(". ")))
            .when(i % 6 == 1, F.concat(F.lit("Author: "), first, F.lit(" "), last, F.lit(". By "), first, F.lit(" "), last, F.lit(". ")))
            .when(i % 6 == 2, F.concat(F.lit("Written by "), first, F.lit(" "), last, F.lit(". ")))
            .when(i % 6 == 3, F.lit("By Staff Writer. ")).otherwise(F.lit("")))
    return t.documents.select("doc_id", "source", F.concat(head, F.coalesce("text", F.lit(""))).alias("text"))


_FIRST, _LAST = "['Anna', 'Boris', 'Carla', 'Dmitri', 'Elena'][doc_id % 5 + 1]", "['Smith', 'Jones', 'Brown'][(doc_id // 5) % 3 + 1]"
BYLINED_SQL = f"""
select doc_id, source, case doc_id % 6 when 0 then 'By ' || {_FIRST} || ' ' || {_LAST} || '. '
  when 1 then 'Author: ' || {_FIRST} || ' ' || {_LAST} || '. By ' || {_FIRST} || ' ' || {_LAST} || '. '
  when 2 then 'Written by ' || {_FIRST} || ' ' || {_LAST} || '. ' when 3 then 'By Staff Writer. ' else '' end || coalesce(text, '') as text from documents
"""
_FOUND = " || ".join(f"regexp_extract_all(text, '{p}', 1)" for p in BYLINE_PATTERNS)
_DESKS = "[" + ", ".join(S.q(a) for a in NOISE_AUTHORS) + "]"


@register("varied_bylines", ops=("I10", "H22"), sql=f"""
with f as (select doc_id, unnest({_FOUND}) as n, generate_subscripts({_FOUND}, 1) as pos from ({BYLINED_SQL}) b),
k as (select doc_id, trim(n) as n, min(pos) as pos from f where length(trim(n)) >= 5 and not list_contains({_DESKS}, lower(trim(n))) group by 1, 2)
select d.doc_id, coalesce(string_agg(n, '|' order by pos), '') as bylines from documents d left join k on d.doc_id = k.doc_id group by d.doc_id
""")
def q_varied_bylines(spark, sf_dir):
    """Distinct bylines of each document, in the order in which they are found."""
    return bylined(Tables(spark, sf_dir)).select("doc_id", F.concat_ws("|", bylines_col("text")).alias("bylines"))


@register("varied_byline_outlets", ops=("I10", "H22", "D9"), sql=f"""
with f as (select source, unnest({_FOUND}) as n from ({BYLINED_SQL}) b)
select source, count(distinct trim(n)) as authors from f where length(trim(n)) >= 5 and not list_contains({_DESKS}, lower(trim(n))) group by source
""")
def q_varied_byline_outlets(spark, sf_dir):
    """Bylines merged over all articles of an outlet."""
    d = bylined(Tables(spark, sf_dir)).select("source", F.explode(bylines_col("text")).alias("author")).distinct()
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("authors"))


_LINKS = ["/2024/a{0}", "/about/{0}", "https://other{0}.example/news/x", "ftp://other.example/blog/y", "/politics/{0}/b", "//cdn.example/story/z", "/p/{0}"]


@register("varied_article_urls", ops=("I9",), sql=f"""
with l as (select page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) as origin,
                  [{', '.join(S.q(x).replace('{0}', "' || page_id || '") for x in _LINKS)}] as hs from pages),
h as (select page_id, generate_subscripts(hs, 1) as pos, origin, unnest(hs) as h from l where page_id % 5 <> 0),
a as (select page_id, pos, case when starts_with(h, '/') then origin || h else h end as h from h),
k as (select *, row_number() over (partition by page_id order by pos) as rk from a
      where starts_with(h, 'http') and ({' or '.join(f"contains(h, {S.q(p)})" for p in ARTICLE_URL_PATTERNS)}))
select p.page_id, coalesce(string_agg(h, ' ' order by pos) filter (where rk <= 3), '') as urls from pages p left join k on p.page_id = k.page_id group by p.page_id
""")
def q_varied_article_urls(spark, sf_dir):
    """The first three article links of each page, made absolute; every fifth page has no links."""
    key = F.col("page_id").cast("string")
    links = F.array(*[F.concat(*[p for i, part in enumerate(x.split("{0}")) for p in ([key] if i else []) + [F.lit(part)]]) for x in _LINKS])
    p = Tables(spark, sf_dir).pages.select("page_id", "url", F.when(F.col("page_id") % 5 != 0, links).otherwise(F.slice(links, 1, 0)).alias("links"))
    return p.select("page_id", F.concat_ws(" ", article_urls("links", "url")).alias("urls"))
