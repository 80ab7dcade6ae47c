"""More of the engine's operators as queries with their SQL: pages built from the
driver's columns and parsed back, postings and their history, rule files,
reconciles, contracts, messages and reports."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars, text
from tidemark.operators import medallion, merge, quality, reports, rules
from tidemark.plans.queries import WORDS, joined
from tidemark.plans.registry import query, table
from tidemark.session import materialize, scratch_dir
from tidemark.sources import contracts, crawl, pages, scan, sites
from tidemark.streaming import sink

NOW = dt.datetime(2026, 1, 2, 3, 4, 5)
STAMP = "2026-01-02T03:04:05Z"
RULES = Path(__file__).parent.parent / "rules"


def cat(*parts: Column | str) -> Column:
    """Columns and plain strings, joined."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


# --- pages -------------------------------------------------------------------


def ld(*fields: tuple[str, Column]) -> Column:
    block = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), *[c.alias(n) for n, c in fields]))
    return cat('<script type="application/ld+json">{oops</script><script type="application/ld+json">', block, "</script>")


@query(
    "pages_itviec",
    f"""
    select sha256('https://jobs/' || p_partkey) as job_id, 'https://jobs/' || p_partkey as job_url, p_name as title, p_brand as company_name,
           '/c/' || p_size as company_url, p_type as location,
           case when p_size % 2 = 0 then 'REMOTE' else 'AT_OFFICE' end as work_arrangement,
           (date '2026-01-02' - (date '2025-12-01' + (p_size % 20)))::int as posted_days_ago, p_size // 12 as min_years_experience,
           'VN' as country, p_brand || ',' || p_type as tech_stack, 'first ' || p_size || ',second' as responsibilities, 'a ' || p_size || ',b' as skills,
           'NEGOTIABLE' as salary_type, 'USD' as currency, '{STAMP}' as crawled_at, 'itviec' as source
    from part where p_size > 1
    """,
)
def pages_itviec(spark, d) -> DataFrame:
    """Sections, tags up to the stop heading, structured data, the canonical link."""
    size = F.col("p_size").cast("string")
    posted = F.date_format(F.date_add(F.lit(dt.date(2025, 12, 1)), F.col("p_size") % 20), "yyyy-MM-dd")
    block = ld(
        ("datePosted", posted),
        ("hiringOrganization", F.struct(F.col("p_brand").alias("name"))),
        ("experienceRequirements", F.struct(F.col("p_size").alias("monthsOfExperience"))),
        ("jobLocation", F.array(F.struct(F.struct(F.lit("VN").alias("addressCountry")).alias("address")))),
    )
    head = F.when(F.col("p_size") > 1, cat("<h1>\n ", F.replace("p_name", F.lit(" "), F.lit("  ")), "</h1>")).otherwise("")
    page = cat(
        '<html><head><link rel="canonical" href="https://jobs/', F.col("p_partkey").cast("string"), '">', block, "</head><body>", head,
        '<h3><a href="/c/', size, '">Shop</a></h3><div class="text-rich-grey text-truncate">', F.col("p_type"), "</div><span>",
        F.when(F.col("p_size") % 2 == 0, "Remote").otherwise("here"), '</span><a class="itag">', F.col("p_brand"), '</a><a class="x itag">', F.col("p_type"),
        '</a><a class="itag">', F.col("p_brand"), "</a><h2>Job description</h2><p>Text</p><ul><li>first ", size,
        "<li>second</ul><h2>Your skills and experience</h2><div>- a ", size, '<br>• b</div><h2>More jobs for you</h2>\n<a class="itag">other</a></body></html>',
    )
    out = pages.parse_postings(table(spark, d, "part").select(page.alias("page")), "itviec", NOW)
    return out.select(
        "job_id", "job_url", "title", "company_name", "company_url", "location", "work_arrangement", "posted_days_ago", "min_years_experience", "country",
        *[joined(F.col(c)).alias(c) for c in ("tech_stack", "responsibilities", "skills")], "salary_type", "currency", "crawled_at", "source",
    )


@query(
    "pages_topcv",
    """
    with s as (select *, s_acctbal * 25000 as low, (s_acctbal + s_nationkey) * 25000 as high from supplier),
    r as (select *, case when low > 0 then round_even(low / case when s_nationkey % 2 = 0 then 1 else 25000 end, 0)::bigint end as a,
                    case when high > 0 then round_even(high / case when s_nationkey % 2 = 0 then 1 else 25000 end, 0)::bigint end as b from s)
    select s_name as title, case when a is not null and b is not null then case when a = b then 'FIXED' else 'RANGE' end
                                 when a is not null then 'FROM' when b is not null then 'UP_TO' else 'NEGOTIABLE' end as salary_type,
           a::int as salary_min_usd, b::int as salary_max_usd, 'Region ' || s_nationkey as location,
           case when s_nationkey % 3 = 0 then 'HYBRID' else 'AT_OFFICE' end as work_arrangement, 's' || s_nationkey || ' people' as company_size,
           'Rust,Go' as tech_stack, 'must ' || s_suppkey as skills, 'may ' || s_suppkey as nice_to_have, 'perk' as benefits, 'do ' || s_suppkey as responsibilities
    from r
    """,
)
def pages_topcv(spark, d) -> DataFrame:
    """Salaries with exchange, description sections, the optional marker, labels."""
    nation, key = F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")
    low, high = F.col("s_acctbal") * 25_000, (F.col("s_acctbal") + F.col("s_nationkey")) * 25_000
    said = cat(
        "<h2>Mô tả công việc</h2><ul><li>do ", key, "</li></ul><h2>Yêu cầu ứng viên</h2><ul><li>must ", key,
        "</li></ul><p>Ưu tiên:</p><ul><li>may ", key, "</li></ul><h2>Quyền lợi</h2><ul><li>perk</li></ul>",
    )
    currency = F.when(F.col("s_nationkey") % 2 == 0, "usd").otherwise("VND")
    block = ld(
        ("title", F.col("s_name")),
        ("description", said),
        ("skills", F.lit("Rust, Go ,Rust")),
        ("baseSalary", F.struct(currency.alias("currency"), F.struct(low.alias("minValue"), high.alias("maxValue")).alias("value"))),
        ("jobLocation", F.struct(F.struct(cat("Region ", nation).alias("addressRegion")).alias("address"))),
    )
    page = cat(
        block, '<div class="box-job-information-detail-item">', F.when(F.col("s_nationkey") % 3 == 0, "Kết hợp từ xa").otherwise("x"), "</div>",
        '<div class="box-company-info-detail__list--item-label">Quy mô:</div><div>s', nation, " people</div>",
    )
    out = pages.parse_postings(table(spark, d, "supplier").select(page.alias("page")), "topcv", NOW)
    lists = [joined(F.col(c)).alias(c) for c in ("tech_stack", "skills", "nice_to_have", "benefits", "responsibilities")]
    return out.select("title", "salary_type", "salary_min_usd", "salary_max_usd", "location", "work_arrangement", "company_size", *lists)


@query(
    "pages_careerviet",
    """
    with s as (select *, (s_nationkey + 1) * 1000000 as low, (s_nationkey + 1 + s_suppkey % 2) * 1000000 as high from supplier)
    select s_name as title, 'RANGE' as salary_type, round_even(low / 25000, 0)::int as salary_min_usd, round_even(high / 25000, 0)::int as salary_max_usd,
           'City ' || s_nationkey as location, 'Trade ' || s_nationkey as company_industry,
           case when s_suppkey % 3 = 0 then 'REMOTE' else 'AT_OFFICE' end as work_arrangement, 0 as posted_days_ago,
           'https://careerviet.vn/co/' || s_nationkey as company_url, 'A,B' as benefits, 'x,y' as tech_stack
    from s
    """,
)
def pages_careerviet(spark, d) -> DataFrame:
    """Details by label, displayed salaries, phrases, welfare, chips, a list of blocks."""
    nation = F.col("s_nationkey").cast("string")
    low, high = (F.col("s_nationkey") + 1).cast("string"), (F.col("s_nationkey") + 1 + F.col("s_suppkey") % 2).cast("string")
    row = lambda label, value: cat("<li><strong>", label, ":</strong><p>", value, "</p></li>")
    page = cat(
        '<script type="application/ld+json">[{"@type": "Other"}, {"@type": "JobPosting", "datePosted": "2026-02-01T00:00:00Z", "baseSalary": {"value": {"value": "x"}}}]</script><h1>',
        F.col("s_name"), '</h1><a class="job-company-name" href="/co/', nation, '">Co</a><section class="job-detail-content"><ul>',
        row("LƯƠNG", cat(low, " - ", high, " triệu VND")), row("Địa điểm", cat("City ", nation)), row("Ngành nghề", cat("Trade ", nation)), row("Lương", "1 Tr"),
        '</ul></section><div class="detail-row"><h2>Mô tả công việc</h2><p>', F.when(F.col("s_suppkey") % 3 == 0, "fully  remote").otherwise("remote controls"),
        '</p></div><ul class="welfare-list"><li>A</li><li>B</li><li>A</li></ul><div class="job-tags"><a>x</a><a>y</a><a>x</a></div>',
    )
    out = pages.parse_postings(table(spark, d, "supplier").select(page.alias("page")), "careerviet", NOW)
    return out.select(
        "title", "salary_type", "salary_min_usd", "salary_max_usd", "location", "company_industry", "work_arrangement", "posted_days_ago", "company_url",
        joined(F.col("benefits")).alias("benefits"), joined(F.col("tech_stack")).alias("tech_stack"),
    )


@query(
    "pages_indeed",
    """
    with c as (select *, o_totalprice * 10 as pay, case o_orderpriority when '1-URGENT' then 12 when '2-HIGH' then 1 else 0 end as per from orders),
    p as (select *, case when per > 0 then round_even(pay / per, 0)::bigint end as m from c)
    select 'https://vn.indeed.com/viewjob?jk=k' || o_orderkey as job_url, 'Order ' || o_orderkey as title,
           case when m >= 80 then 'FIXED' else 'NEGOTIABLE' end as salary_type, case when m >= 80 then m::int end as salary_min_usd, 'USD' as currency,
           case when o_orderstatus = 'F' then 'REMOTE' else 'AT_OFFICE' end as work_arrangement,
           'is } open […truncated by Indeed; full text is on the posting]' as description, 'perk ' || o_orderstatus as benefits, 'Vietnam' as country
    from p where o_orderkey % 7 <> 0
    """,
)
def pages_indeed(spark, d) -> DataFrame:
    """Cards of one embedded object a page, pay by period, clipped snippets."""
    key = F.col("o_orderkey").cast("string")
    pay = F.col("o_totalprice") * 10
    card = F.struct(
        cat("Order ", key).alias("displayTitle"),
        F.when(F.col("o_orderkey") % 7 != 0, cat("k", key)).alias("jobkey"),
        F.struct(pay.alias("min"), pay.alias("max"), F.expr("case o_orderpriority when '1-URGENT' then 'yearly' when '2-HIGH' then 'MONTHLY' else 'ONCE' end").alias("type")).alias("extractedSalary"),
        F.struct(F.lit("usd").alias("currency")).alias("salarySnippet"),
        (F.col("o_orderstatus") == "F").alias("remoteLocation"),
        F.lit("<b>is }</b>  open …").alias("snippet"),
        F.array(*[F.struct(cat("perk ", F.col("o_orderstatus")).alias("label"))] * 2).alias("rankedBenefits"),
    )
    results = F.struct(F.collect_list(card).alias("results"))
    blob = F.to_json(F.struct(F.struct(results.alias("mosaicProviderJobCardsModel")).alias("metaData")))
    of_page = F.expr("o_custkey div 4")  # a page holds the orders of four customers
    held = table(spark, d, "orders").groupBy(of_page.alias("p")).agg(cat(f"<script>{pages.CARDS_MARKER} = ", blob, "; more {}</script>").alias("page"))
    out = pages.parse_postings(held, "indeed", NOW)
    return out.select("job_url", "title", "salary_type", "salary_min_usd", "currency", "work_arrangement", "description", joined(F.col("benefits")).alias("benefits"), "country")


def envelope(source: str, page: Column) -> Column:
    return F.to_json(F.struct(F.lit(source).alias("source"), page.alias("page")))


@query(
    "catalogue_mslearn",
    """
    select 'https://l/n' || n_nationkey as url, n_name as title, 'MODULE' as content_kind, 'INTRO' as level, 'fr' as language,
           'a b,role ' || n_regionkey as tags, 'r' || n_regionkey as parent_uids, '' as child_uids from nation
    union all
    select 'https://l/r' || r_regionkey, r_name, 'LEARNING_PATH', 'UNKNOWN', 'en', '', '',
           (select string_agg('n' || n_nationkey, ',' order by n_nationkey) || ',gone' from nation where n_regionkey = r_regionkey) from region
    """,
)
def catalogue_mslearn(spark, d) -> DataFrame:
    """Modules and paths of one page each region; parents resolved within the page."""
    uid = cat("n", F.col("n_nationkey").cast("string"))
    module = F.struct(
        uid.alias("uid"), cat("https://l/", uid, "?x=1").alias("url"), F.col("n_name").alias("title"), F.lit("module").alias("type"), F.lit("fr-fr").alias("locale"),
        F.array(F.lit("beginner")).alias("levels"), F.array(F.lit("a-b")).alias("products"), F.array(cat("role-", F.col("n_regionkey").cast("string"))).alias("roles"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("n_nationkey", uid.alias("uid"), module.alias("m"))))
    by = table(spark, d, "nation").groupBy("n_regionkey").agg(ordered.alias("o")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = cat("r", F.col("r_regionkey").cast("string"))
    children = F.concat(F.transform("o", lambda x: x["uid"]), F.array(F.lit("gone")))
    path = F.struct(key.alias("uid"), cat("https://l/", key).alias("url"), F.col("r_name").alias("title"), F.lit("learningPath").alias("type"), children.alias("modules"))
    body = F.to_json(F.struct(F.transform("o", lambda x: x["m"]).alias("modules"), F.array(path).alias("learningPaths")))
    out = pages.parse_courses(by.select(envelope("mslearn", body).alias("page")), NOW)
    return out.select("url", "title", "content_kind", "level", "language", *[joined(F.col(c)).alias(c) for c in ("tags", "parent_uids", "child_uids")])


@query(
    "catalogue_others",
    """
    select 'mitlearn' as source, 'https://m/' || c_custkey as url, c_name as title, c_mktsegment as provider, 'de' as language, 'COURSE' as content_kind, 'Topic' as tags,
           (c_custkey % 9)::int as weeks, c_acctbal >= 0 as is_free from customer
    union all
    select 'freecodecamp', 'https://www.freecodecamp.org/learn/' || lower(replace(p_brand, '#', '-')) || '-' || p_partkey || '/',
           upper(p_brand[1]) || lower(replace(substr(p_brand, 2), '#', ' ')) || ' ' || p_partkey, 'freeCodeCamp', 'en', 'COURSE',
           lower(replace(p_brand, '#', ' ')) || ' ' || p_partkey, null, true from part
    """,
)
def catalogue_others(spark, d) -> DataFrame:
    item = F.struct(
        F.lit(None).cast("string").alias("url"), cat("https://m/", F.col("c_custkey").cast("string")).alias("learn_url"), F.col("c_name").alias("title"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("platform"), F.array(F.lit("de-at"), F.lit("en")).alias("languages"),
        F.array(F.struct(F.lit("Topic").alias("name")), F.struct(F.lit("").alias("name"))).alias("topics"), (F.col("c_custkey") % 9).cast("int").alias("min_weeks"),
        (F.col("c_acctbal") >= 0).alias("free"),
    )
    mit = table(spark, d, "customer").groupBy(F.col("c_nationkey")).agg(F.collect_list(item).alias("results"))
    slug = cat(F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))), "-", F.col("p_partkey").cast("string"), ".json")
    listing = F.concat(F.collect_list(F.struct(slug.alias("name"))), F.array(F.struct(F.lit("README.md").alias("name"))))
    fcc = table(spark, d, "part").groupBy("p_size").agg(listing.alias("names"))
    both = mit.select(envelope("mitlearn", F.to_json(F.struct("results"))).alias("page")).unionByName(fcc.select(envelope("freecodecamp", F.to_json("names")).alias("page")))
    unknown = spark.range(1).select(envelope("elsewhere", F.lit("[]")).alias("page"))
    out = pages.parse_courses(both.unionByName(unknown), NOW)
    return out.select("source", "url", "title", "provider", "language", "content_kind", joined(F.col("tags")).alias("tags"), F.col("duration_weeks_min").alias("weeks"), "is_free")


@query(
    "catalogue_markdown",
    """
    with f as (select p_brand, p_size, row_number() over (partition by p_brand order by min(p_partkey)) as i, min(p_partkey) as k from part group by p_brand, p_size),
    c as (select p_brand, list(p_size order by k) as sizes from f group by p_brand)
    select 'https://www.' || lower(replace(p_brand, '#', '')) || '.org/a?b=' || s as url, 'T' || s as title, lower(replace(p_brand, '#', '')) || '.org' as provider,
           'One' || case when s % 2 = 0 then ',Two' else '' end as tags
    from (select p_brand, unnest(sizes) as s from c)
    """,
)
def catalogue_markdown(spark, d) -> DataFrame:
    """Sections, titles before links, repeated urls."""
    link = cat("](https://www.", F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), ".org/a?b=", F.col("p_size").cast("string"), ")")
    one = cat("- T", F.col("p_size").cast("string"), " | [see", link, ".\n")
    two = F.when(F.col("p_size") % 2 == 0, cat("  - [again", link, "\n")).otherwise("- [no link](#x)\n")
    sizes = table(spark, d, "part").select("p_brand", "p_size").distinct()
    page = cat("- [front](https://x.org)\n### One\nprose\n", F.array_join(F.collect_list(one), ""), "### Two\n", F.array_join(F.collect_list(two), ""))
    held = sizes.groupBy("p_brand").agg(page.alias("md")).select(envelope("csvideo", F.col("md")).alias("page"))
    out = pages.parse_courses(held, NOW)
    return out.select("url", "title", "provider", joined(F.col("tags")).alias("tags"))


# --- scalars -----------------------------------------------------------------


@query(
    "text_scalars",
    r"""
    select doc_id, coalesce(nullif(trim(case when doc_id % 3 = 0 then '  ' else lang end), ''), source) as first_value,
           trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) as collapsed,
           case when text is null then null else coalesce(nullif(
             trim(regexp_replace(regexp_replace('<i>' || substr(text, 1, 80) || '</i>', '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '') || ' [cut]', '[cut]') end as clipped,
           coalesce(case when len(text) > 400 then 'long' end, 'short') as kind
    from documents
    """,
)
def text_scalars(spark, d) -> DataFrame:
    """Coalesce chains, collapsed blanks, clipped snippets, defaults."""
    said = F.substring("text", 1, 80)
    first = scalars.first_filled(F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("lang")), F.col("source"))
    return table(spark, d, "documents").select(
        "doc_id",
        first.alias("first_value"),
        scalars.collapse(F.coalesce("text", F.lit(""))).alias("collapsed"),
        F.trim(scalars.unclip(cat("<i>", said, "</i>", "…"), "[cut]")).alias("clipped"),
        scalars.mapped(F.when(F.char_length("text") > 400, "l"), {"l": "long"}, "short").alias("kind"),
    )


@query(
    "time_scalars",
    f"""
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as stamp, ts::varchar as utc,
           case when epoch_ms(ts) <= epoch_ms(timestamp '2024-01-15') then ((epoch_ms(timestamp '2024-01-15') - epoch_ms(ts)) // 86400000)::int end as days
    from events
    """,
)
def time_scalars(spark, d) -> DataFrame:
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    stamped = events.withColumn("stamp", scalars.stamp(F.col("ts")))
    millis = F.unix_millis("ts")
    whole = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    plain = F.regexp_replace(F.regexp_replace(whole, "0+$", ""), r"\.$", "")
    read = medallion.parsed(whole).eqNullSafe(F.col("ts"))  # a naive stamp is UTC
    return stamped.select(
        "event_id", "stamp", F.when(read, plain).alias("utc"),
        scalars.days_since_epoch_ms(millis, F.lit(dt.datetime(2024, 1, 15, tzinfo=dt.UTC))).alias("days"),
    )


@query(
    "fallback_lists",
    """
    select o_orderkey, case when o_orderkey % 3 = 0 then o_orderpriority when o_orderkey % 3 = 1 then o_orderstatus else '' end as items,
           case when o_orderstatus = 'F' then 'HYBRID' when o_orderstatus = 'O' then 'REMOTE' else 'AT_OFFICE' end as arrangement
    from orders
    """,
)
def fallback_lists(spark, d) -> DataFrame:
    key, none = F.col("o_orderkey") % 3, F.array().cast("array<string>")
    items = scalars.first_nonempty(F.when(key == 0, F.array("o_orderpriority")), F.when(key == 1, F.array("o_orderstatus")).otherwise(none))
    said = F.when(F.col("o_orderstatus") == "F", "Remote or  HYBRID work").when(F.col("o_orderstatus") == "O", "a Remote position, làm").otherwise("a remote town")
    return table(spark, d, "orders").select("o_orderkey", joined(items).alias("items"), scalars.arrangement_by_phrases(said).alias("arrangement"))


# --- postings and their history ----------------------------------------------


def postings(spark, d) -> DataFrame:
    """Orders as crawled postings: a customer is a job, an order a sighting of it."""
    bare = F.col("o_orderkey") % 5
    return table(spark, d, "orders").select(
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")).alias("job_id"),
        cat("Job ", F.col("o_orderstatus")).alias("title"),
        F.lit("RANGE").alias("salary_type"),
        F.when(bare != 0, (F.col("o_custkey") % 3).cast("int")).alias("salary_min_usd"),
        F.lit(None).cast("int").alias("salary_max_usd"),
        F.lit("here").alias("location"),
        F.lit("REMOTE").alias("work_arrangement"),
        F.lit(None).cast("string").alias("description"),
        F.array("o_orderstatus", F.lit("x")).alias("tech_stack"),
        *[F.array().cast("array<string>").alias(c) for c in ("skills", "responsibilities", "benefits")],
        F.date_format(F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86_400), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("crawled_at"),
    )


_POSTINGS = """
    p as (select case when o_custkey % 10 <> 0 then o_custkey::varchar end as job_id, 'Job ' || o_orderstatus as title, o_orderstatus,
                 case when o_orderkey % 5 <> 0 then o_custkey % 3 else 0 end as low, o_orderdate + to_seconds(o_orderkey % 86400) as seen from orders),
    h as (select *, sha256(concat_ws(chr(31), title, 'RANGE', low, 0, 'here', 'REMOTE', '', o_orderstatus || '|x', '', '', '')) as content_hash from p where job_id is not null)
"""


@query(
    "posting_history",
    f"with {_POSTINGS} select job_id, title, content_hash, strftime(max(seen), '%Y-%m-%dT%H:%M:%SZ') as crawled_at from h group by all",
)
def posting_history(spark, d) -> DataFrame:
    """Null keys out, content fingerprints, the latest sighting of each content."""
    return medallion.history(postings(spark, d)).select("job_id", "title", "content_hash", "crawled_at")


@query(
    "posting_history_in_runs",
    f"with {_POSTINGS} select job_id, content_hash, strftime(max(seen), '%Y-%m-%dT%H:%M:%SZ') as crawled_at from h group by all",
)
def posting_history_in_runs(spark, d) -> DataFrame:
    """Three runs, the last one twice, give what one full load gives."""
    every = postings(spark, d)
    target = None
    for until in ("1994", "1997", "9999", "9999"):
        landed = every.filter(F.col("crawled_at") < until)
        target = materialize(medallion.append_history(target, landed), "history")
    return target.select("job_id", "content_hash", "crawled_at")


@query(
    "posting_current",
    f"""
    with {_POSTINGS}, g as (select job_id, title, content_hash, max(seen) as seen from h group by all)
    select job_id, title, content_hash from g qualify row_number() over (partition by job_id order by seen desc, content_hash desc) = 1
    """,
)
def posting_current(spark, d) -> DataFrame:
    """Models in dependency order, with their data tests."""
    graph = quality.ModelGraph()
    graph.add("current", ["history"], medallion.current, {"one row a job": lambda t: quality.unique(t, "job_id")})
    graph.add("history", ["bronze"], medallion.history, {"keyed": lambda t: quality.not_null(t, "job_id")})
    return graph.run({"bronze": postings(spark, d)})["current"].select("job_id", "title", "content_hash")


@query("snapshot_copy", "select n_nationkey, n_name, 2::bigint as tables from nation")
def snapshot_copy(spark, d) -> DataFrame:
    """A copy made before a change, and the check that both tables are there."""
    mark = uuid.uuid4().hex[:8]
    name = f"nations_{mark}"
    table(spark, d, "nation").write.option("path", f"{scratch_dir(spark)}/{name}").saveAsTable(name)
    held = scan.select_table(spark, name, ["n_nationkey", "n_name", "n_nationkey"])
    copy = f"{name}_before"
    held.write.option("path", f"{scratch_dir(spark)}/{copy}").saveAsTable(copy)
    medallion.require_tables(spark, name, copy)
    found = sum(spark.catalog.tableExists(t) for t in (name, copy, f"{name}_absent"))
    out = materialize(scan.select_table(spark, copy, ["n_nationkey", "n_name", "n_nationkey"]), "copy")
    for t in (name, copy):
        spark.sql(f"drop table {t}")
    return out.withColumn("tables", F.lit(found).cast("long"))


@query("brace_scan", "select r_regionkey, r_name, null::int as n_nationkey from region union all select null, null, n_nationkey from nation")
def brace_scan(spark, d) -> DataFrame:
    return scan.union_scan(spark, f"{d}/{{region,nation}}.parquet").select("r_regionkey", "r_name", "n_nationkey")


@query(
    "stream_consumers",
    """
    select consumer, count(*)::bigint as landed, count(distinct event_id)::bigint as distinct_events, count(*) filter (event_type = 'click')::bigint as clicks
    from events, (select unnest(['a', 'b', 'b']) as consumer) group by consumer
    """,
)
def stream_consumers(spark, d) -> DataFrame:
    """Two consumers from the start, each with its checkpoint; one loses its offsets
    after landing and repeats; records are parsed and published behind the sink."""
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    day = F.date_format(F.current_timestamp(), "yyyy-MM-dd")
    parse = lambda rows: rows.select("event_id", F.upper("event_type").alias("kind"), day.alias("day"))
    for consumer, run in (("a", 1), ("b", 1), ("b", 2)):
        files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
        out = f"{base}/published/consumer={consumer}"
        query_ = sink.start_sink(
            files, f"{base}/landed/consumer={consumer}", f"{base}/offsets-{consumer}-{run}", parse=parse, seconds=None, max_records=500,
            publish=lambda rows, out=out: rows.write.mode("append").parquet(out),
        )
        query_.awaitTermination()
    landed = spark.read.parquet(f"{base}/landed")
    # every row lies under the day on which it was written, and was published once for each landing
    here = landed.filter(F.abs(F.datediff(F.col("dt").cast("date"), F.col("day").cast("date"))) <= 1).groupBy("consumer").agg(
        F.count(F.lit(1)).alias("landed"), F.count_distinct("event_id").alias("distinct_events"), F.count_if(F.col("kind") == "CLICK").alias("clicks")
    )
    published = spark.read.parquet(f"{base}/published").groupBy("consumer").agg(F.count(F.lit(1)).alias("n"))
    same = here.join(published, "consumer").filter("landed = n")
    return same.select("consumer", "landed", "distinct_events", "clicks")


# --- rule files --------------------------------------------------------------


@query("normal_forms", "select p_partkey, lower(p_name) as tag, p_name as folded, p_name as wide from part")
def normal_forms(spark, d) -> DataFrame:
    """Decoration, case and compatibility forms around a name."""
    name = F.col("p_name")
    tag = cat("  2) • ", F.upper(name), " ;")
    wide = F.translate(name, "aeiou", "ａｅｉｏｕ")
    return table(spark, d, "part").select("p_partkey", text.normalise(tag).alias("tag"), text.nfkc(name).alias("folded"), text.nfkc(wide).alias("wide"))


TAG_RULES = rules.TagMap.from_yaml(str(RULES / "parts_tags.yaml"), WORDS)
ROLE_RULES = rules.RoleRules.from_yaml(str(RULES / "parts_roles.yaml"))
OVERRIDES = rules.load_overrides(str(RULES / "parts_overrides.yaml"), set(WORDS.kinds))
ORDER = rules.Prerequisites.from_yaml(str(RULES / "parts_prerequisites.yaml"), set(WORDS.kinds))

_TAGGED = "(select p_partkey, unnest([split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), 'Theaters', 'THENTRE.']) as tag from part)"
_KIND = "case when tag in ('Theaters', 'THENTRE.') then 'skill' when lower(tag) = 'red' then 'role' when lower(tag) = 'small' then 'subject' end"


@query("tag_kinds", f"select p_partkey, tag, {_KIND} as kind, case when tag in ('Theaters', 'THENTRE.') then 'Theatre' end as skill from {_TAGGED}")
def tag_kinds(spark, d) -> DataFrame:
    """A tag map from its file: skills, roles and subjects, and names of skills."""
    word = F.split("p_name", " ")
    tags = F.array(F.get(word, F.lit(0)), F.get(word, F.lit(1)), F.lit("Theaters"), F.lit("THENTRE."))
    rows = table(spark, d, "part").select("p_partkey", F.explode(tags).alias("tag"))
    return rows.select("p_partkey", "tag", TAG_RULES.classify(F.col("tag")).alias("kind"), TAG_RULES.skill(F.col("tag")).alias("skill"))


def part_courses(spark, d) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return table(spark, d, "part").select(
        key.alias("id"), cat("https://parts/", key).alias("url"), F.when(F.col("p_size") % 2 == 0, "a thentre, ander").otherwise(F.col("p_name")).alias("title"),
        F.when(F.col("p_size") % 3 == 0, "Elles").alias("summary"), F.array(F.lit("Theaters"), F.lit("small")).alias("tags"),
        F.lit("parts").alias("source"), F.when(F.col("p_size") % 2 == 0, "COURSE").otherwise("MODULE").alias("content_kind"),
    )


_COURSES = """
    c as (select p_partkey::varchar as id, p_partkey as k, p_size, case when p_size % 2 = 0 then ['Ander', 'Theatre'] else [] end as t,
                 case when p_size % 3 = 0 then ['Elle'] else [] end as s from part),
    taught as (select *, list_filter(list_distinct(t || case when k = 3 then ['Heron', 'Tion'] else [] end),
                                     lambda x: not (k = 5 and x = 'Theatre') and not (k = 3 and x = 'Tion')) as teaches from c),
    m as (select *, list_filter(list_distinct(t || s || ['Theatre']),
                                lambda x: not list_contains(t, x) and not (k = 5 and x = 'Theatre') and not (k = 3 and x in ('Tion', 'Heron'))) as mentions from taught)
"""


@query(
    "curated_courses",
    f"with {_COURSES} select id, array_to_string(list_sort(teaches), ',') as teaches, array_to_string(list_sort(mentions), ',') as mentions from m",
)
def curated_courses(spark, d) -> DataFrame:
    """Titles, summaries, mapped tags and the curated file."""
    out = rules.course_skills(part_courses(spark, d), WORDS, TAG_RULES, OVERRIDES)
    return out.select("id", *[joined(F.array_sort(c)).alias(c) for c in ("teaches", "mentions")])


@query(
    "course_report",
    f"""
    with {_COURSES} select 'parts' as source, case when p_size % 2 = 0 then 'COURSE' else 'MODULE' end as content_kind, count(*)::bigint as total,
        count(*) filter (len(teaches) > 0)::bigint as kept, count(*) filter (len(teaches) = 0)::bigint as dropped,
        count(*) filter (len(teaches) = 0 and len(mentions) > 0)::bigint as dropped_with_mentions
    from m group by 2
    """,
)
def course_report(spark, d) -> DataFrame:
    courses = part_courses(spark, d)
    return reports.course_coverage(courses, rules.course_skills(courses, WORDS, TAG_RULES, OVERRIDES))


@query(
    "relation_report",
    f"with {_COURSES}, k as (select * from m where len(teaches) > 0) select 'teaches' as relation, sum(len(teaches))::bigint as n from k union all select 'mentions', sum(len(mentions))::bigint from k",
)
def relation_report(spark, d) -> DataFrame:
    return reports.relation_counts(rules.course_edges(rules.course_skills(part_courses(spark, d), WORDS, TAG_RULES, OVERRIDES)))


@query("teaching_sample", f"with {_COURSES} select case when p_size % 2 = 0 then 'a thentre, ander' end as title from m where list_contains(teaches, 'Theatre') order by 1 limit 10")
def teaching_sample(spark, d) -> DataFrame:
    courses = part_courses(spark, d)
    return reports.teaching_sample(courses, rules.course_skills(courses, WORDS, TAG_RULES, OVERRIDES), "Theatre")


@query(
    "curation_gaps",
    f"""
    with {_COURSES} select 'uncovered' as what, n as name from (select unnest(['Tion', 'Onthe', 'Lichen', 'Elle', 'Heron', 'Ander', 'Theatre']) as n)
        where n not in (select unnest(teaches) from m union select unnest(mentions) from m where len(teaches) > 0)
    union all select 'stale', u from (select unnest(['https://parts/3', 'https://parts/5', 'https://parts/none']) as u) where u not in (select 'https://parts/' || p_partkey from part)
    """,
)
def curation_gaps(spark, d) -> DataFrame:
    """Names that no course covers, and curated urls that are no course."""
    courses = part_courses(spark, d)
    edges = rules.course_edges(rules.course_skills(courses, WORDS, TAG_RULES, OVERRIDES))
    names = spark.createDataFrame([(n,) for n in WORDS.kinds], "skill string")
    urls = spark.createDataFrame([(u,) for u in [*OVERRIDES, "https://parts/none"]], "url string")
    uncovered = reports.uncovered(names, edges).select(F.lit("uncovered").alias("what"), F.col("skill").alias("name"))
    return uncovered.unionByName(reports.stale_urls(urls, courses).select(F.lit("stale").alias("what"), F.col("url").alias("name")))


@query(
    "vocabulary_terms",
    """
    select term, skill, (len(term) >= 3) as scannable, case when skill in ('Heron', 'Ander') then 'professional' else 'technical' end as kind from (values
      ('ander', 'Ander'), ('andere', 'Ander'), ('elle', 'Elle'), ('elles', 'Elle'), ('heron', 'Heron'), ('lichen', 'Lichen'), ('lichung', 'Lichen'), ('onthe', 'Onthe'),
      ('theatre', 'Theatre'), ('thentre', 'Theatre'), ('tion', 'Tion'), ('tioning', 'Tion')) t(term, skill)
    where exists (select 1 from part)
    """,
)
def vocabulary_terms(spark, d) -> DataFrame:
    return spark.createDataFrame([(t, c, ok, WORDS.kind(c)) for t, c, ok in WORDS.terms()], "term string, skill string, scannable boolean, kind string")


@query(
    "prerequisite_file",
    """
    select * from (values ('Elle', 'Lichen', 'provider_order', 'parts desk', 2), ('Elle', 'Theatre', 'curated', 'parts desk', 2),
                          ('Lichen', 'Tion', 'curated', 'the garden', 1), ('Theatre', 'Tion', 'curated', 'parts desk', 1)) t(skill, requires, evidence_kind, curated_by, layer)
    """,
)
def prerequisite_file(spark, d) -> DataFrame:
    """Edges of a checked file with their layers; what a skill requires."""
    edges = ORDER.table(spark)
    layers = rules.layers_of(edges, spark.createDataFrame([(n,) for n in WORDS.kinds], "skill string"))
    required = spark.createDataFrame([(s, r) for s in WORDS.kinds for r in ORDER.required_by(s)], "skill string, requires string")
    return edges.join(required, ["skill", "requires"]).join(layers, "skill").select("skill", "requires", "evidence_kind", "curated_by", "layer")


@query(
    "supply_layers",
    """
    with recursive n as (select n_nationkey as k, n_regionkey as r from nation),
    e as (select a.k as k, b.k as needs from n a join n b on a.r = b.r and b.k < a.k and (a.k - b.k) % 3 <> 2),
    w as (select k, 0 as layer from n union select e.k, w.layer + 1 from w join e on e.needs = w.k)
    select k::varchar as skill, max(layer)::int as layer from w group by k
    """,
)
def supply_layers(spark, d) -> DataFrame:
    """Layers of a graph over the nations table."""
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    a, b = n.select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r")), n.select(F.col("n_nationkey").alias("needs"), F.col("n_regionkey").alias("r"))
    edges = a.join(b, "r").filter("needs < k and (k - needs) % 3 <> 2").select(F.col("k").cast("string").alias("skill"), F.col("needs").cast("string").alias("requires"))
    return rules.layers_of(edges, a.select(F.col("k").cast("string").alias("skill")))


@query(
    "model_replies",
    """
    select doc_id::varchar as job_id, case when doc_id % 7 = 0 then null else '[' || length(substr(coalesce(text, ''), 1, 12000)) || ']' end as reply, doc_id % 7 = 0 as failed
    from documents
    """,
)
def model_replies(spark, d) -> DataFrame:
    """Calls of a stub where the rows are; a call that raises is marked."""

    def ask(said: str) -> str:
        if said.startswith("fail:"):
            raise OSError("down")
        return f"[{len(said)}]"

    body = F.when(F.col("doc_id") % 7 == 0, F.lit("fail:")).otherwise(F.col("text"))
    return rules.ask_model(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("job_id"), body.alias("text")), ask)


def role_rows(spark, d) -> DataFrame:
    jobs = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), cat(F.col("p_type"), " ", F.col("p_name")).alias("title"))
    return rules.role_plan(jobs, ROLE_RULES, "rules:v3", F.lit(dt.date(2026, 1, 2)))


_TITLE = "lower(p_type || ' ' || p_name)"
_ANY = lambda words: " or ".join(f"contains({_TITLE}, '{w}')" for w in words)
_TOOLS, _PAINTS = ("widget", "gizmo", "bolt", "gear"), ("red", "blue")
_ROLE_SQL = f"""
    r as (select p_partkey, {_TITLE} as t, {_ANY(_TOOLS)} as tool, {_ANY(_PAINTS)} as paint, {_ANY(["anvil"])} as size, {_ANY(["hot"])} as hot, {_ANY(["cold"])} as cold from part),
    f as (select *, case when tool::int + paint::int + size::int > 1 then 'AMBIGUOUS' when tool then 'tool' when paint then 'paint' when size then 'size'
                         when hot and cold then 'AMBIGUOUS' when hot then 'tool' when cold then 'paint' else 'UNKNOWN' end as family from r)
"""


@query(
    "role_report",
    f"""
    with {_ROLE_SQL} select count(*)::bigint as postings, count(*) filter (family not in ('UNKNOWN', 'AMBIGUOUS'))::bigint as usable, count(*) filter (family = 'UNKNOWN')::bigint as unknown,
        count(*) filter (family = 'AMBIGUOUS')::bigint as ambiguous, (100 * count(*) filter (family not in ('UNKNOWN', 'AMBIGUOUS')) // count(*))::bigint as percent from f
    """,
)
def role_report(spark, d) -> DataFrame:
    return reports.classified(role_rows(spark, d))


@query(
    "seniority_report",
    """
    select case when contains(lower(p_type || ' ' || p_name), 'promo') then 'lead' when contains(lower(p_type || ' ' || p_name), 'economy') then 'senior' when contains(lower(p_type || ' ' || p_name), 'standard') then 'junior' else 'NONE' end as seniority,
           count(*)::bigint as postings from part group by 1
    """,
)
def seniority_report(spark, d) -> DataFrame:
    return reports.seniority_counts(role_rows(spark, d))


@query(
    "ambiguous_report",
    f"""
    with {_ROLE_SQL} select array_to_string(list_filter([case when paint or cold then 'paint' end, case when size then 'size' end, case when tool or hot then 'tool' end],
        lambda x: x is not null), ',') as families, count(*)::bigint as n from f where family = 'AMBIGUOUS' group by 1 order by n desc, families limit 10
    """,
)
def ambiguous_report(spark, d) -> DataFrame:
    return reports.ambiguous_combinations(role_rows(spark, d), 10)


@query("unknown_report", f"with {_ROLE_SQL} select p_type || ' ' || p_name as title, count(*)::bigint as n from f join part using (p_partkey) where family = 'UNKNOWN' group by 1 order by n desc, title limit 20")
def unknown_report(spark, d) -> DataFrame:
    return reports.unknown_titles(role_rows(spark, d), 20)


@query(
    "role_plan_rows",
    f"""
    with {_ROLE_SQL} select p_partkey as job_id, family, 'rules:v3' as method, '2026-01-02' as classified_at,
           len(list_filter([{", ".join(f"contains(t, '{x}')" for x in (*_TOOLS, *_PAINTS, "anvil", "hot", "cold"))}], lambda x: x))::bigint as rules
    from f
    """,
)
def role_plan_rows(spark, d) -> DataFrame:
    plan = role_rows(spark, d)
    return plan.select("job_id", "family", "method", F.col("classified_at").cast("string").alias("classified_at"), F.size("matched_rules").cast("long").alias("rules"))


@query(
    "extraction_report",
    "select (3 * count(*))::bigint as bullets_in, count(*) filter (p_size % 2 = 0)::bigint as skills_out from part",
)
def extraction_report(spark, d) -> DataFrame:
    bullets = F.array("p_name", "p_brand", "p_type")
    skills = F.when(F.col("p_size") % 2 == 0, F.array("p_brand")).otherwise(F.array().cast("array<string>"))
    return reports.extraction_stats(table(spark, d, "part").select(bullets.alias("b"), skills.alias("s")), "b", "s")


@query(
    "oversized_report",
    """
    select 'names' as "column", count(distinct p_name)::bigint as items, count(distinct p_name) filter (strlen(p_name) > 16)::bigint as too_long from part
    union all select 'types', count(distinct p_type)::bigint, count(distinct p_type) filter (strlen(p_type) > 16)::bigint from part
    """,
)
def oversized_report(spark, d) -> DataFrame:
    rows = table(spark, d, "part").select(F.array("p_name", F.lit("")).alias("names"), F.array("p_type").alias("types"))
    return reports.oversized(rows, ["names", "types"], 16)


# --- reconciles --------------------------------------------------------------


@query(
    "touch_sightings",
    """
    with a as (select user_id, min(ts) as f, max(ts) as l from events where ts < timestamp '2024-01-16' and user_id % 2 = 0 group by user_id),
    b as (select user_id, min(ts) as f, max(ts) as l from events group by user_id)
    select a.user_id, least(a.f, b.f)::varchar as first_seen_at, greatest(a.l, b.l)::varchar as last_seen_at from a join b using (user_id)
    """,
)
def touch_sightings(spark, d) -> DataFrame:
    events = table(spark, d, "events")
    seen = lambda rows: medallion.sightings(rows, "user_id", F.col("ts"))
    out = merge.touch(seen(events.filter("ts < timestamp_ntz'2024-01-16' and user_id % 2 = 0")), seen(events), ["user_id"])
    return out.select("user_id", *[F.col(c).cast("string").alias(c) for c in ("first_seen_at", "last_seen_at")])


@query("named_rows", "select s_suppkey, n_name from supplier join nation on s_nationkey = n_nationkey where n_regionkey <> 2")
def named_rows(spark, d) -> DataFrame:
    """An equi-join that resolves names and inserts none."""
    lookup = table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("name"), "n_name")
    found, _ = merge.resolve_names(table(spark, d, "supplier"), lookup, "s_nationkey")
    return found.select("s_suppkey", "n_name")


@query(
    "routed_names",
    """
    select 'brands' as "column", count(distinct p_brand)::bigint as names, 0::bigint as too_long from part
    union all select 'texts', count(distinct t)::bigint, count(distinct t) filter (strlen(t) > 2000)::bigint from (select repeat(p_name, p_size * 3) as t from part)
    """,
)
def routed_names(spark, d) -> DataFrame:
    """Array columns to their lookups, with how many names are over the limit."""
    jobs = table(spark, d, "part").select(
        F.col("p_partkey").alias("job_id"), F.array("p_brand", F.lit("")).alias("brands"), F.array(F.expr("repeat(p_name, p_size * 3)")).alias("texts")
    )
    routed, counts = merge.route_fields(jobs, {"brands": "technologies", "texts": "benefits"})
    left = {c: p.select("name").distinct().count() for c, p in routed.items()}
    table_ = spark.createDataFrame(list(left.items()), "column string, left long")
    return counts.join(table_, "column").filter(F.col("left") == F.col("names") - F.col("too_long")).select("column", "names", "too_long")


@query(
    "course_upsert",
    """
    select p_partkey::varchar as id, case when p_size > 40 then p_name || ' new' else p_name end as title,
           case when p_size > 40 or p_size <= 5 then '2026-01-02' else '2025-01-01' end as updated_at from part
    """,
)
def course_upsert(spark, d) -> DataFrame:
    """Only rows that differ, and new ones, are touched."""
    part = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_size")
    there = part.filter("p_size > 5").select("id", F.col("p_name").alias("title"), F.lit("2025-01-01").alias("updated_at"))
    come = part.select("id", F.when(F.col("p_size") > 40, cat(F.col("p_name"), " new")).otherwise(F.col("p_name")).alias("title"))
    return merge.courses_upsert(there, come, F.lit("2026-01-02"))


@query("requirement_backfill", "select p_partkey, p_name as skills from part where p_size % 4 <> 0")
def requirement_backfill(spark, d) -> DataFrame:
    """Rows whose list differs from the table's: null and empty are different."""
    part = table(spark, d, "part")
    key = F.col("p_size") % 4
    there = part.select("p_partkey", F.when(key == 0, F.array("p_name")).when(key == 1, F.array().cast("array<string>")).when(key == 2, F.array("p_brand")).alias("skills"))
    out = merge.differing(there, part.select("p_partkey", F.array("p_name").alias("skills")), "p_partkey", ["skills"])
    return out.select("p_partkey", joined(F.col("skills")).alias("skills"))


@query("partial_paths", "select conv_id, count(*)::bigint as n from conversations group by conv_id having conv_id % 3 = 0")
def partial_paths(spark, d) -> DataFrame:
    """Containers that state more children than they list."""
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.col("turn").cast("string")).alias("child_uids"))
    stated = rows.withColumn("child_count", F.size("child_uids") + F.when(F.col("conv_id") % 3 == 0, 2).otherwise(0))
    return merge.partial_containers(stated).select("conv_id", F.size("child_uids").cast("long").alias("n"))


_RELATIONS = f"""
    with {_COURSES}, ids as (select name, row_number() over (order by name) as id from (select unnest(['Ander', 'Elle', 'Heron', 'Lichen', 'Onthe', 'Theatre', 'Tion']) as name)),
    e as (select id as course_id, unnest(teaches) as name, 'teaches' as relation from m where len(teaches) > 0
          union all select id, unnest(mentions), 'mentions' from m where len(teaches) > 0),
    after_ as (select distinct course_id, ids.id as skill_id, relation from e join ids using (name)),
    before_ as (select * from after_ where course_id::int % 2 = 0 union all select 'gone', 1, 'teaches' where exists (select 1 from part))
"""


def _lookup(spark) -> DataFrame:
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(sorted(WORDS.kinds))], "id long, name string")


@query(
    "course_skill_rebuild",
    _RELATIONS
    + """
    select 'added' as change, count(*)::bigint as n, false as written from after_ where course_id::int % 2 <> 0
    union all select 'kept', count(*)::bigint, false from after_ where course_id::int % 2 = 0 union all select 'removed', 1::bigint, false
    union all select 'kept', count(*)::bigint, true from after_
    """,
)
def course_skill_rebuild(spark, d) -> DataFrame:
    """A dry run by default; then written, and a second run changes nothing."""
    edges = materialize(rules.course_edges(rules.course_skills(part_courses(spark, d), WORDS, TAG_RULES, OVERRIDES)), "edges")
    empty = spark.createDataFrame([], "course_id string, skill_id long, relation string")
    whole = merge.course_skills_change(empty, edges, _lookup(spark)).after
    gone = spark.range(1).select(F.lit("gone").alias("course_id"), F.lit(1).cast("long").alias("skill_id"), F.lit("teaches").alias("relation"))
    held = {"table": materialize(whole.filter("cast(course_id as int) % 2 = 0").unionByName(gone), "target")}
    change = merge.course_skills_change(held["table"], edges, _lookup(spark))
    write = lambda df: held.update(table=df)
    dry = change.apply(write)
    untouched = held["table"] is change.before
    change.apply(write, dry_run=False)
    again = merge.course_skills_change(held["table"], edges, _lookup(spark)).apply(write)
    rows = [(k, n, not untouched) for k, n in dry.items()] + [(k, n, True) for k, n in again.items()]
    return spark.createDataFrame(rows, "change string, n long, written boolean")


@query(
    "reconciled_rules",
    """
    select 'prerequisites' as what, 'added' as change, 3::bigint as n union all select 'prerequisites', 'kept', 1 union all select 'prerequisites', 'removed', 1
    union all select 'terms', 'added', 11 union all select 'terms', 'kept', 1
    """,
)
def reconciled_rules(spark, d) -> DataFrame:
    """Prerequisites and terms against tables that hold one right and one old row."""
    lookup = _lookup(spark)
    ids = {r.name: r.id for r in lookup.collect()}
    schema = "skill_id long, requires_skill_id long, evidence_kind string, why string, curated_by string"
    old = spark.createDataFrame([(ids["Theatre"], ids["Tion"], "curated", "w", "c"), (ids["Tion"], ids["Elle"], "curated", "w", "c")], schema)
    wanted = ORDER.table(spark)
    terms = spark.createDataFrame(WORDS.terms(), "term string, skill string, scannable boolean")
    there = spark.createDataFrame([("elle", ids["Elle"], True)], "term string, skill_id long, scannable boolean")
    rows = []
    for what, change in (("prerequisites", merge.prerequisites_change(old, wanted, lookup)), ("terms", merge.terms_change(there, terms, lookup))):
        rows += [(what, k, n) for k, n in change.apply(lambda df: None).items()]
    return spark.createDataFrame(rows, "what string, change string, n long")


@query(
    "model_edge_rewrite",
    """
    with t as (select o_custkey as job_id, o_orderkey as skill_id, case when o_orderstatus = 'F' then 'model' else 'rule' end as method from orders),
    j as (select distinct c_custkey as job_id from customer where c_nationkey < 5),
    kept as (select * from t where not (method = 'model' and job_id in (select job_id from j))),
    e as (select o_custkey as job_id, o_orderkey as skill_id from orders join j on o_custkey = job_id where o_orderkey % 2 = 0)
    select job_id, skill_id, method from kept union all
    select job_id, skill_id, 'model' from e where not exists (select 1 from kept k where k.job_id = e.job_id and k.skill_id = e.skill_id)
    """,
)
def model_edge_rewrite(spark, d) -> DataFrame:
    """A model's earlier edges go, other methods' stay and win, every job is marked."""
    orders = table(spark, d, "orders")
    method = F.when(F.col("o_orderstatus") == "F", "model").otherwise("rule")
    base = [F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("skill_id"), F.lit(0.5).alias("confidence"), F.lit("w").alias("rationale")]
    target = orders.select(*base, method.alias("method"))
    jobs = table(spark, d, "customer").filter("c_nationkey < 5").select(F.col("c_custkey").alias("job_id"))
    edges = orders.select(*base).filter("skill_id % 2 = 0").join(jobs, "job_id", "left_semi").unionByName(orders.select(*base).limit(0))
    done = spark.createDataFrame([], "job_id long, model string, edges long, matched_at timestamp")
    out, marks = merge.model_edges(target, done, edges, jobs, "m1", F.lit(NOW))
    if marks.count() != jobs.count():
        raise AssertionError("a job is not marked")
    return out.select("job_id", "skill_id", "method")


@query(
    "serving_merge",
    """
    select n_nationkey, case when n_nationkey % 2 = 0 then upper(n_name) || '!' else n_name end as n_name,
           case when n_nationkey % 2 = 0 then greatest(n_regionkey, 2) else n_regionkey end as n_regionkey from nation
    """,
)
def serving_merge(spark, d) -> DataFrame:
    """Rows merged by key into an embedded database and read back; the region only moves up."""
    url = f"jdbc:derby:memory:serving{uuid.uuid4().hex};create=true"
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute("CREATE TABLE nations (n_nationkey INT NOT NULL PRIMARY KEY, n_name VARCHAR(100), n_regionkey INT)")
    connection.close()
    kinds = {"createTableColumnTypes": "n_name VARCHAR(100)"}  # this database compares no CLOBs
    held = {"on_driver": True}  # in the driver's memory: executors do not reach it
    scan.merge_jdbc(nation.filter("n_nationkey % 3 <> 0"), url, "nations", ["n_nationkey"], **held, **kinds)
    changed = nation.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, cat(F.upper("n_name"), "!")).otherwise(F.col("n_name")).alias("n_name"),
                            F.when(F.col("n_nationkey") % 2 == 0, F.greatest("n_regionkey", F.lit(2))).otherwise(F.col("n_regionkey")).alias("n_regionkey"))
    scan.merge_jdbc(changed, url, "nations", ["n_nationkey"], forward={"n_regionkey": "greatest"}, **held, **kinds)
    back = scan.read_jdbc(spark, url, "nations", **held)
    return back.toDF(*[c.lower() for c in back.columns])


# --- contracts and messages --------------------------------------------------

NATION = {
    "type": "record", "name": "Nation",
    "fields": [
        {"name": "id", "type": "long"}, {"name": "name", "type": ["null", "string"], "default": None}, {"name": "region", "type": {"type": "enum", "name": "R", "symbols": ["A", "B", "C"]}},
        {"name": "tags", "type": {"type": "array", "items": "string"}}, {"name": "small", "type": "int"},
    ],
}


@query(
    "framed_messages",
    "select n_nationkey::bigint as id, case when n_nationkey % 2 = 0 then n_name end as name, ['A', 'B', 'C'][n_regionkey % 3 + 1] as region, n_name || ',x' as tags, 258 as schema_id from nation",
)
def framed_messages(spark, d) -> DataFrame:
    """Avro records framed as messages, opened and decoded again."""
    import pyarrow as pa

    rows = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("long").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("name"),
        F.element_at(F.array(*map(F.lit, "ABC")), F.col("n_regionkey") % 3 + 1).alias("region"), F.array("n_name", F.lit("x")).alias("tags"), F.lit(1).alias("small"),
    )

    def encode(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([contracts.encode_record(NATION, r) for r in batch.to_pylist()], pa.binary())], ["payload"])

    framed = rows.mapInArrow(encode, "payload binary").select(contracts.frame(F.col("payload"), 258).alias("value"))
    parts = framed.select(contracts.unframe(F.col("value")).alias("m")).select("m.*")
    ids = parts.agg(F.min("schema_id"), F.max("schema_id")).first()
    out = contracts.decode_messages(parts, NATION)
    return out.select("id", "name", "region", joined(F.col("tags")).alias("tags"), F.lit(ids[0] if ids[0] == ids[1] else -1).alias("schema_id"))


@query(
    "contract_violations",
    """
    select o_orderkey as id, concat_ws(',', case when o_orderkey % 11 = 0 then 'id' end, case when o_orderstatus not in ('A', 'B', 'C', 'F') then 'region' end,
           case when o_orderkey % 3 = 0 then 'tags' end, case when o_totalprice > 100000 then 'small' end) as faults
    from orders where o_orderkey % 11 = 0 or o_orderstatus not in ('A', 'B', 'C', 'F') or o_orderkey % 3 = 0 or o_totalprice > 100000
    """,
)
def contract_violations(spark, d) -> DataFrame:
    """Nulls where none may be, values outside an enum, numbers too wide."""
    schema = {**NATION, "fields": [*NATION["fields"][:2], {**NATION["fields"][2], "type": {"type": "enum", "name": "R", "symbols": ["A", "B", "C", "F"]}}, *NATION["fields"][3:]]}
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(
        key.alias("key"), F.when(key % 11 != 0, key).alias("id"), F.lit("n").alias("name"), F.col("o_orderstatus").alias("region"),
        F.array(F.when(key % 3 != 0, F.lit("t"))).alias("tags"), F.when(F.col("o_totalprice") > 100_000, F.lit(1 << 40)).otherwise(F.lit(1)).cast("string").alias("small"),
    )
    out = contracts.invalid_rows(rows, schema)
    return out.select(F.col("key").alias("id"), joined(F.col("faults")).alias("faults"))


@query(
    "contract_types",
    """
    select * from (values ('id', 'Int64', 'bigint', 'int64', false), ('name', 'Nullable(String)', 'string', 'string', true), ('region', 'String', 'string', 'string', false),
                          ('tags', 'Array(String)', 'array<string>', 'list<item: string>', false), ('small', 'Int32', 'int', 'int32', false)) t(field, ddl, spark, arrow, nullable)
    """,
)
def contract_types(spark, d) -> DataFrame:
    struct, arrow = contracts.to_struct(NATION), contracts.to_arrow(NATION)
    lines = dict(line.strip().rstrip(",").split(" ", 1) for line in contracts.to_ddl(NATION, "nations").split("\n")[1:-1])
    rows = [(f.name, lines[f.name], f.dataType.simpleString(), str(arrow.field(f.name).type), f.nullable) for f in struct.fields]
    return spark.createDataFrame(rows, "field string, ddl string, spark string, arrow string, nullable boolean")


@query(
    "contract_checks",
    r"""
    select n_name as name, regexp_full_match(lower(n_name), '[a-z][a-z0-9]*([-_][a-z0-9]+)*') and n_regionkey <> 0 as ok,
           case when regexp_full_match(lower(n_name), '[a-z][a-z0-9]*([-_][a-z0-9]+)*') and n_regionkey <> 0 then 'topic_' || n_regionkey || ':1:1' end as topic,
           case when regexp_full_match(lower(n_name), '[a-z][a-z0-9]*([-_][a-z0-9]+)*') and n_regionkey <> 0 then 'DELAY=' || n_nationkey end as env
    from nation
    """,
)
def contract_checks(spark, d) -> DataFrame:
    """Contracts from rows: names, needed fields, environment and topics to create."""
    rows, made = [], []
    for r in table(spark, d, "nation").orderBy("n_nationkey").collect():  # 25 rows of configuration
        body = {"schema": "s", "topic": f"topic_{r.n_regionkey}" if r.n_regionkey else "", "settings": {"delay": r.n_nationkey, "empty": ""}}
        try:
            c = contracts.Contract(r.n_name.lower(), "producer", body)
        except ValueError:
            rows.append((r.n_name, False, None, None))
            continue
        made.append(c)
        rows.append((r.n_name, True, f"{body['topic']}:1:1", ",".join(f"{k}={v}" for k, v in c.environment().items())))
    wanted = contracts.plan_topics([f"{t}:1:1" for t in contracts.topics(made)], set())
    if {t for t, _, _ in wanted} != {x[2].split(":")[0] for x in rows if x[2]}:
        raise AssertionError("a topic is not planned")
    return spark.createDataFrame(rows, "name string, ok boolean, topic string, env string")


# --- crawls ------------------------------------------------------------------


@query(
    "crawled_sites",
    """
    with n as (select n_nationkey as k, n_regionkey as r, n_name from nation),
    pages_ as (
      select 'itviec' as source, 'https://itviec.com/it-jobs/' || k as url, n_name as page from n where r < 3
      union all select 'topcv', 'https://www.topcv.vn/viec/' || k || '.html', n_name from n where r < 3 and k % 4 <> 0
      union all select 'careerviet', 'https://careerviet.vn/vi/tim-viec-lam/' || k || '.html', n_name from n where r < 3 and k % 4 <> 1
      union all select 'indeed', 'https://vn.indeed.com/jobs?q=' || n_name || '&l=&start=0', '{"jobkey": ' || k || '}' from n where k % 2 = 0 and r <> 2
      union all select 'mitlearn', 'https://m?page=' || r_regionkey, r_name from region where r_regionkey < 3)
    select source, url, page from pages_
    """,
)
def crawled_sites(spark, d) -> DataFrame:
    """Four sites and a catalogue over saved pages made of the nations: listings up
    to an empty one (or one without new links), cards, canonical links, skipped
    and retried fetches, robots, sign-in pages, paging to a ceiling, a dead source."""
    nations = [(r.n_nationkey, r.n_regionkey, r.n_name) for r in table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name").collect()]  # 25 rows
    regions = [(r.r_regionkey, r.r_name) for r in table(spark, d, "region").select("r_regionkey", "r_name").orderBy("r_regionkey").collect()]
    saved: dict[str, str] = {}
    for r in range(5):
        of = [k for k, region, _ in nations if region == r]
        shown = of if r < 3 else []  # the fourth listing is empty (or, below, has nothing new)
        saved[f"https://itviec.com/it-jobs?page={r + 1}"] = "".join(f'<div class="job-card" {sites.ITVIEC_LINK}="/it-jobs/{k}/content?i=0"></div>' for k in shown)
        titles = "".join(f'<div class="job-item-search-result"><h3 class="title"><a href="/viec/{k}.html?ta={r}#x">t</a></h3></div>' for k in shown)
        saved[f"{sites.TOPCV_LISTING}?page={r + 1}"] = titles + '<div class="suggested"><h3 class="title"><a href="/no">t</a></h3></div>'
        listing = sites.SITES["careerviet"].listing(r + 1)
        again = of if r < 3 else [k for k, region, _ in nations if region == 0]
        cards = [f'<div class="job-item"><div class="title"><a href="/vi/{"other" if k % 4 == 1 else "tim-viec-lam"}/{k}.html">t</a></div></div>' for k in again]
        saved[listing] = "".join(cards)
    for k, region, name in nations:
        saved[f"https://itviec.com/it-jobs/{k}"] = name
        saved[f"https://careerviet.vn/vi/tim-viec-lam/{k}.html"] = name
        if k % 4:
            saved[f"https://www.topcv.vn/viec/{k}.html"] = name
        page = f'{{"jobkey": {k}}}' if k % 2 == 0 else "no cards"
        saved[f"https://vn.indeed.com/jobs?q={name}&l=&start=0"] = page if region != 2 else f"{sites.INDEED_SIGN_IN[0]} {page}"
    texts = {f"https://m?page={k}": json.dumps({"next": f"https://m?page={k + 1}", "name": name}) for k, name in regions}

    def fetch(url: str) -> str:
        found = saved.get(url) or texts.get(url)
        if found is None and url not in saved:
            raise crawl.FetchError(404)
        return found or ""

    failed: set[str] = set()

    def throttled(url: str) -> str:
        if url not in failed:  # each page is refused once
            failed.add(url)
            raise crawl.FetchError(429, 0.0)
        return fetch(url)

    patient = crawl.retrying(throttled, sleep=lambda s: None)
    plan = crawl.Crawl({name: (lambda site=site: site.pages(patient, 1, 5)) for name, site in sites.SITES.items()})
    names = [n for _, _, n in nations]
    plan.sources["indeed"] = lambda: sites.searched(fetch, names)
    plan.sources["dead"] = lambda: crawl.paged(fetch, "https://none", lambda p: None)
    plan.sources |= sites.catalogue(fetch, {"mitlearn": "https://m?page=0", "elsewhere": "x"}, ceiling=3).sources
    pages_ = crawl.crawl(spark, plan)
    return pages_.select("source", "url", F.when(F.col("source") == "mitlearn", F.get_json_object("page", "$.name")).otherwise(F.col("page")).alias("page"))


# --- edges, files and messages -----------------------------------------------

EDGY = text.Vocabulary({"technical": {"ASP.NET": [], ".NET": ["dotnet"], "Node.js": ["nodejs"], "C++": [], "C#": ["csharp"], "C": [], "Go": ["golang"], "CI/CD": []}})


@query(
    "term_edges",
    """
    select p_partkey, case p_size % 8 when 0 then 'ASP.NET' when 1 then '.NET' when 2 then '' when 3 then 'Node.js' when 4 then 'C#,C++' when 5 then '' when 6 then 'CI/CD,Go' else '.NET,ASP.NET' end as scanned,
           case p_size % 8 when 0 then 'ASP.NET' when 1 then '.NET' when 2 then '' when 3 then 'Node.js' when 4 then 'C#,C++' when 5 then '' when 6 then 'CI/CD,Go' else '.NET,ASP.NET' end as native
    from part
    """,
)
def term_edges(spark, d) -> DataFrame:
    """Terms with dots and signs at their edges, by the scanner and without a UDF."""
    cases = [
        "a site in ASP.NET", "daily .NET, since 2004", "a net, x.net and C or go", "Node.js, never Node.jsx or xNode.js", "C++ or C#; C++17", "vitamin c+ and #c, nodejs.x",
        "GOLANG through CI/CD.", "dotnet beside asp.net.",
    ]
    said = F.element_at(F.array(*map(F.lit, cases)), F.col("p_size") % 8 + 1)
    empty = F.array().cast("array<string>")
    rows = table(spark, d, "part").select("p_partkey", EDGY.extract_column(empty, said, empty).alias("names"), text.plain_terms(said, EDGY).alias("native"))
    return rows.select("p_partkey", joined(F.array_sort("names")).alias("scanned"), joined(F.array_sort("native")).alias("native"))


@query(
    "message_stream",
    "select n_nationkey::bigint as id, n_name as name, n_nationkey::varchar as key from nation where n_nationkey % 2 = 0",
)
def message_stream(spark, d) -> DataFrame:
    """Framed messages as a consumer gets them, decoded by the sink and landed."""
    import pyarrow as pa

    schema = {"type": "record", "name": "N", "fields": [{"name": "id", "type": "long"}, {"name": "name", "type": ["null", "string"], "default": None}]}
    base = f"{scratch_dir(spark)}/messages-{uuid.uuid4().hex}"
    rows = table(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))

    def encode(batches):
        for batch in batches:
            records = batch.to_pylist()
            payloads = [contracts.encode_record(schema, r) for r in records]
            yield pa.RecordBatch.from_arrays([pa.array([str(r["id"]).encode() for r in records], pa.binary()), pa.array(payloads, pa.binary())], ["key", "payload"])

    sent = rows.mapInArrow(encode, "key binary, payload binary").select("key", contracts.frame(F.col("payload"), 7).alias("value"))
    sent.write.parquet(f"{base}/topic")
    stream = sink.read_files(spark, f"{base}/topic", sent.schema)

    def parse(batch: DataFrame) -> DataFrame:
        opened = contracts.decode_messages(batch.select(contracts.unframe(F.col("value")).alias("m")).select("m.payload"), schema)
        keys = batch.select(F.col("key").cast("string").alias("key"))
        return opened.join(keys, F.col("id").cast("string") == F.col("key"))

    sink.start_sink(stream, f"{base}/landed", f"{base}/offsets", parse=parse, seconds=None).awaitTermination()
    return spark.read.parquet(f"{base}/landed").select("id", "name", "key")


@query(
    "contract_files",
    """
    select lower(replace(r_name, ' ', '-')) as name, 'topic-' || r_regionkey || '-value' as subject, 'DELAY=' || r_regionkey as env, r_regionkey % 2 = 0 as to_register,
           'ORDER BY id' as sort, case when r_regionkey % 3 = 0 then 'crawler:latest' else '' end as unpinned
    from region
    """,
)
def contract_files(spark, d) -> DataFrame:
    """Contracts written as files and read in order; what they render, what is to
    be registered, and images that are not pinned."""
    import tempfile

    import yaml

    with tempfile.TemporaryDirectory() as folder:  # configuration on the driver, read back at once
        for r in table(spark, d, "region").collect():  # five rows
            image = "crawler:latest" if r.r_regionkey % 3 == 0 else "crawler:1.4"
            body = {"kind": "producer", "schema": "nation", "topic": f"topic-{r.r_regionkey}", "settings": {"delay": r.r_regionkey, "off": None}, "resources": [{"image": image}]}
            Path(folder, f"{r.r_name.lower().replace(' ', '-')}.yaml").write_text(yaml.safe_dump(body))
        Path(folder, "default.yaml").write_text("kind: nothing\n")
        found = contracts.load_contracts(folder)
    if [c.name for c in found] != sorted(c.name for c in found):
        raise AssertionError("contracts are not in order")
    spelled = contracts.register(found, {"nation": NATION}, {})
    have = {s: x for s, x in spelled.items() if int(s.split("-")[1]) % 2}
    wanted = contracts.register(found, {"nation": NATION}, have)
    rows = []
    for c in found:
        out = contracts.rendered(c, NATION)
        env = ",".join(f"{k}={v}" for k, v in out["environment"].items())
        rows.append((c.name, out["subject"], env, out["subject"] in wanted, out["ddl"][-11:], ",".join(contracts.unpinned([c.body]))))
    return spark.createDataFrame(rows, "name string, subject string, env string, to_register boolean, sort string, unpinned string")


@query(
    "report_text",
    """
    with c as (select c_mktsegment as seg, count(*)::varchar as n from customer group by 1), w as (select greatest(max(len(seg)), 3) as a from c),
    l as (select 0 as place, rpad('seg', a::int, ' ') || '  n' as line from w union all select row_number() over (order by seg), rpad(seg, a::int, ' ') || '  ' || n from c, w)
    select place::bigint as place, line from l
    """,
)
def report_text(spark, d) -> DataFrame:
    """A report as the text that a log gets."""
    counts = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("seg")).agg(F.count(F.lit(1)).alias("n")).orderBy("seg")
    lines = reports.as_text(counts).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "place long, line string")
