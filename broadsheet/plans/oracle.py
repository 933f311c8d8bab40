"""For each named query the same result as SQL over the tables, written independently of the operators."""

from __future__ import annotations

from broadsheet.plans.views import AS_OF

NOW = f"TIMESTAMP '{AS_OF}'"
LIMIT_S = 6 * 3600

# ---- shared tables ---------------------------------------------------------------

PUBLISHED = """case {id} % 10
    when 0 then strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')
    when 1 then strftime({ts}, '%Y-%m-%d %H:%M:%S')
    when 2 then strftime({ts} + interval 3 hour, '%a, %d %b %Y %H:%M:%S +0300')
    when 3 then strftime({ts}, '%a, %d %b %Y %H:%M:%S GMT')
    when 4 then ' '
    when 5 then strftime({ts}, '%m/%d/%Y')
    when 6 then strftime({ts}, '%d.%m.%Y')
    when 7 then strftime({ts} + interval 3 hour, '%Y-%m-%dT%H:%M:%S.%g+03:00')
    when 8 then '1999' || strftime({ts}, '-%m-%dT%H:%M:%SZ')
    when 9 then '2031' || strftime({ts}, '-%m-%dT%H:%M:%SZ') end"""

A = f"""a as (
  select e.event_id as doc_id, d.doc_id as text_id, d.source, case when e.event_id % 4 = 3 then 'html' else 'rss' end as source_type,
    split_part(d.text, chr(10), 1) as title, 'https://news.example.com/a/' || e.event_id as link,
    d.text as description, {PUBLISHED.format(id='e.event_id', ts='e.ts')} as published,
    d.lang, e.event_type, [d.lang, e.event_type] as categories, e.ts,
    strlen(split_part(d.text, chr(10), 1)) as tb, length(split_part(d.text, chr(10), 1)) as tc,
    strlen(d.text) as db, length(d.text) as dc
  from documents d join events e on e.event_id % (select count(*) from documents) = d.doc_id)"""


def members(size: int, slide: int, name: str = "m") -> str:
    """Every (window, article) pair."""
    floor = f"make_timestamp(epoch_us(ts) - epoch_us(ts) % {slide * 1_000_000})"
    return f"""{name} as (
  select *, {floor} - to_seconds(k * {slide}) as window_start,
    {floor} - to_seconds(k * {slide}) + to_seconds({size}) as window_end
  from a, range({size // slide}) t(k))"""


SLIDING, HOURLY, MINUTE = members(300, 60), members(3600, 3600), members(60, 60)
FIVE, SIX = members(300, 300), members(21_600, 3_600)

W = "window_start, window_end"


def stats(unit: str, minutes: float, source: str = "m") -> str:
    c = "c" if unit == "chars" else "b"
    return f"""select {W}, count(*) as total_articles, count(distinct source) as sources_count,
    sum(t{c}) / count(*) as avg_title_length, sum(d{c}) / count(*) as avg_description_length,
    count(*) / {minutes}e0 as rate_per_min, max(ts) as last_article_at,
    case when max(ts) > window_start
      then count(*) / ((epoch_us(max(ts)) - epoch_us(window_start)) / 1e6) else 0e0 end as rate_per_sec
  from {source} group by {W}"""


# one row per window, kind and key of an article
KEYS = f"""keys as (
  select {W}, 'source' as kind, source as key from m
  union all select {W}, 'source_type', source_type from m
  union all select {W}, 'category', unnest(categories) from m
  union all select {W}, 'keyword', w from (
    select {W}, unnest(regexp_extract_all(lower(title), '\\S+')) as w from m) where length(w) >= 4)"""

COUNTS = f"counts as (select {W}, kind, key, count(*) as n from keys group by all)"

BEST = f"""best as (
  select {W}, key, n, row_number() over (partition by window_start order by n desc, key) as rank
  from counts where kind = 'keyword' qualify rank <= 10)"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def key_counts(window: str, kinds: str) -> str:
    return with_(A, window, KEYS, COUNTS) + f"select * from counts where kind in ({kinds})"


HISTORY = f"h as ({stats('chars', 5, 'm')})"

TITLE = r"regexp_replace(title, '^\s+|\s+$', '', 'g')"
SANITIZE = (
    r"regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace({c}, "
    r"'<script[^>]*>[^\n]*?</script>', '', 'g'), 'on[\pL\p{{M}}\p{{Nd}}\p{{Pc}}]+\s*=', 'data-removed=', 'g'), "
    r"'<[^>]*>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), "
    r"'^\s+|\s+$', '', 'g')"
)
PAGE_LINK = r"regexp_extract(url, '^(https?://[^/?#\s]*[^?#\s]*)', 1)"

RFC = r"strftime({t}, '%Y-%m-%dT%H:%M:%S') || case when epoch_us({t}) % 1000000 = 0 then '' "\
    r"when epoch_us({t}) % 1000 = 0 then strftime({t}, '.%g') else strftime({t}, '.%f') end || '+00:00'"

# instant each form of the publication text stands for; NULL where it is refused
STRICT = f"""case {{id}} % 10 when 0 then date_trunc('second', {{ts}}) when 1 then date_trunc('second', {{ts}})
    when 2 then date_trunc('second', {{ts}}) when 4 then {NOW} when 7 then date_trunc('millisecond', {{ts}})
    when 8 then ('1999' || strftime({{ts}}, '-%m-%d %H:%M:%S'))::timestamp
    when 9 then ('2031' || strftime({{ts}}, '-%m-%d %H:%M:%S'))::timestamp end"""
LENIENT = """case {id} % 10 when 3 then date_trunc('second', {ts}) when 5 then date_trunc('day', {ts})
    when 6 then date_trunc('day', {ts}) else """ + STRICT + " end"

VERDICTS = f"""v as (
  select *, {TITLE} as t, {SANITIZE.format(c='description')} as body,
    {STRICT.format(id='doc_id', ts='ts')} as moment from a),
v2 as (
  select *, case when t = '' then 'Title is empty or too short'
    when strlen(t) > 500 then 'Title is too long (max 500 characters)'
    when strlen(body) > 5000 then 'Description is too long (max 5000 characters)'
    when moment is null then 'Invalid date format: ' || published
    when moment > {NOW} then 'Date is in the future: ' || {RFC.format(t='moment')}
    when year(moment) < 2000 then 'Date is too old (before 2000): ' || {RFC.format(t='moment')} end as error,
  case when t = '' then 'title_empty' when strlen(t) > 500 then 'title_too_long'
    when strlen(body) > 5000 then 'description_too_long' when moment is null then 'date_invalid'
    when moment > {NOW} then 'date_future' when year(moment) < 2000 then 'date_too_old' end as code
  from v)"""

LOCKS = f"""l as (
  select 'https://feeds.example.com/' || user_id as url,
    case when event_type = 'purchase' then 'w' || (event_id % 8) else '' end as locked_by, ts as locked_at
  from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
now as (select max(ts) as t from events),
c as (
  select 'https://feeds.example.com/' || c_custkey as url, c_name as name,
    case when c_mktsegment = 'BUILDING' then 'html' else 'rss' end as type from customer),
held as (select url from l, now where locked_by <> '' and epoch_us(now.t) - epoch_us(locked_at) <= {LIMIT_S}000000)"""

SAMPLES = """s as (
  select event_type as scraper, user_id as iteration, round(value * 100) - 500 as cpu,
    round(value * 100) * 2 - 900 as mem, round(value * 100) as sec from events)"""
RUNS = SAMPLES + """,
r as (
  select scraper, iteration, sum(sec) as sec, min(cpu) as c1, max(cpu) as c2, min(mem) as m1, max(mem) as m2
  from s group by all),
u as (
  select scraper, sum(sec) / count(*) as avg_execution_time, min(sec) as min_execution_time,
    max(sec) as max_execution_time, sum(c1) / count(*) as avg_cpu_across_runs, sum(c2) / count(*) as avg_max_cpu,
    sum(m1) / count(*) as avg_memory_across_runs, sum(m2) / count(*) as avg_max_memory
  from r group by scraper)"""
COMPARED = RUNS + """,
x as (
  unpivot (select scraper, avg_execution_time, avg_cpu_across_runs, avg_max_cpu, avg_memory_across_runs,
    avg_max_memory from u) on columns(* exclude scraper) into name metric value value),
cmp as (
  select b.metric, b.value as baseline, c.value as candidate
  from x b join x c on b.metric = c.metric and b.scraper = 'click' and c.scraper = 'view'
  where b.value <> 0 and c.value <> 0)"""

PAGE_TITLE = "regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"
for _entity, _char in (("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("#39", "chr(39)"), ("nbsp", "chr(160)"), ("amp", "'&'")):
    PAGE_TITLE = f"regexp_replace({PAGE_TITLE}, '&{_entity};?', {_char}, 'g')"
PAGE_TITLE = f"trim({PAGE_TITLE})"

SLIDING_COUNTS = with_(A, SLIDING, KEYS, COUNTS)


def half_even(a: str, b: str) -> str:
    """The quotient of whole numbers, half-even to two places."""
    q, r = f"({a} * 100 // {b})", f"({a} * 100 % {b})"
    return f"({q} + (2 * {r} > {b} or (2 * {r} = {b} and {q} % 2 = 1))::int) / 100e0"


def sql() -> dict[str, str]:
    hour_stats = with_(A, HOURLY) + stats("bytes", 60)
    slide_stats = with_(A, SLIDING) + stats("chars", 5)
    six_keys = with_(A, SIX, KEYS, COUNTS, BEST)
    history = with_(A, FIVE, HISTORY)
    emerging = """,
tot as (select window_start, sum(n) as total from counts where kind = '{kind}' group by all),
sh as (select counts.window_start, key, n, n / total as share from counts join tot using (window_start)
  where kind = '{kind}')
select coalesce(s.window_start, p.window_start + interval 1 hour) as window_start, coalesce(s.key, p.key) as key,
  coalesce(s.n, 0)::bigint as n, coalesce(s.share, 0e0) as share, coalesce(p.share, 0e0) as previous_share
from sh s full join sh p on p.key = s.key and p.window_start + interval 1 hour = s.window_start
where s.key is not null or p.window_start + interval 1 hour in (select window_start from tot)"""
    rss = """select source, regexp_replace(title, '^\\s+|\\s+$', '', 'g') as title, link,
    length(regexp_replace(description, '^\\s+|\\s+$', '', 'g')) as desc_chars,
    {authors} as authors, {categories} as categories, date_trunc('second', ts) as published_time,
    'rss' as source_type from a"""
    return {
        "articles_view": with_(A) + """select doc_id, source, source_type, title, link, dc as desc_chars, published,
            array_to_string(categories, ',') as categories, ts as scraped_at from a""",
        "event_time": with_(A) + f"""select doc_id, case doc_id % 3 when 0 then date_trunc('second', ts)
            when 1 then null
            -- without a scrape time the ISO-like publication texts count, then the given instant
            else case doc_id % 10 when 0 then date_trunc('second', ts) when 1 then date_trunc('second', ts)
              when 7 then date_trunc('millisecond', ts)
              when 8 then ('1999' || strftime(ts, '-%m-%d %H:%M:%S'))::timestamp
              when 9 then ('2031' || strftime(ts, '-%m-%d %H:%M:%S'))::timestamp else {NOW} end end as ts,
            doc_id % 3 = 1 as rejected from a""",
        "routed_sources": with_(A) + """select case when doc_id % 7 = 0 then 'rejects' else source_type end as route,
            case when doc_id % 7 = 0 then 'unknown source type: atom' end as error, count(*) as n from a group by all""",
        "gathered_articles": with_(A) + """select doc_id, source_type,
            case when source_type = 'rss' then dc else 0 end as desc_chars,
            case when source_type = 'rss' then published end as published from a""",
        "unique_links": f"select min(page_id) as page_id, {PAGE_LINK} as link from pages group by all",
        "sliding_window_stats": slide_stats,
        "tumbling_window_stats": hour_stats,
        "minute_window_stats": with_(A, MINUTE) + stats("chars", 1),
        "sliding_source_counts": key_counts(SLIDING, "'source'"),
        "tumbling_type_counts": key_counts(HOURLY, "'source_type'"),
        "category_counts": key_counts(SIX, "'category'"),
        "window_keywords": key_counts(SLIDING, "'keyword'"),
        "window_breakdowns": key_counts(SIX, "'source', 'source_type', 'category', 'keyword'"),
        "selected_breakdowns": key_counts(HOURLY, "'source', 'source_type'"),
        "top_keywords": six_keys + f"select {W}, key as word, n as frequency, rank from best",
        "window_view_flat": six_keys + """select window_start, kind, key, n from counts where kind <> 'keyword'
            union all select window_start, 'keyword', key, n from best
            union all select window_start, 'sources', string_agg(key, ',' order by key), sum(n)::bigint
              from counts where kind = 'source' group by all""",
        "rounded_windows": with_(A, SIX, """s as (select window_start, count(*) as n, sum(tc)::bigint as t,
            sum(dc)::bigint as d from m group by all)""") + f"""select window_start, {half_even('t', 'n')} as avg_title_length,
            {half_even('d', 'n')} as avg_description_length, {half_even('n', '360')} as rate_per_min,
            n as article_count from s""",
        "byte_vs_char_length": with_(A, HOURLY) + """select window_start, count(*) as n,
            sum(tc)::bigint as title_chars, sum(tb)::bigint as title_bytes, sum(dc)::bigint as desc_chars,
            sum(db)::bigint as desc_bytes from m group by all""",
        "top_source_per_window": SLIDING_COUNTS + f""", st as ({stats('chars', 5)}),
            lead as (select window_start, key, n from counts where kind = 'source'
              qualify row_number() over (partition by window_start order by n desc, key) = 1)
            select st.window_start, window_end, total_articles, sources_count, rate_per_min,
              key as top_source, n as top_count from st join lead using (window_start)""",
        "capped_window_stats": with_(A, SIX, """c as (select * from m
            qualify row_number() over (partition by window_start order by ts desc, doc_id desc) <= 5)""")
        + "select * exclude rate_per_sec from (" + stats("chars", 360, "c") + ")",
        "dropped_per_window": with_(A, SIX) + f"""select {W}, count(*) as arrived, least(count(*), 5) as kept,
            greatest(count(*) - 5, 0) as dropped from m group by all""",
        "dense_windows": with_(A, SLIDING, f"s as ({stats('chars', 5)})",
            "b as (select min(window_start) as lo, max(window_start) as hi from s)") + """
            select t.w as window_start, t.w + interval 5 minute as window_end,
              coalesce(total_articles, 0) as total_articles, coalesce(sources_count, 0) as sources_count,
              coalesce(avg_title_length, 0) as avg_title_length,
              coalesce(avg_description_length, 0) as avg_description_length, coalesce(rate_per_min, 0) as rate_per_min,
              last_article_at, coalesce(rate_per_sec, 0) as rate_per_sec
            from (select unnest(generate_series(lo, hi, interval 1 minute)) as w from b) t
            left join s on s.window_start = t.w""",
        "count_windows": with_(A, """n as (select *, (row_number() over (partition by source order by ts, doc_id) - 1)
            // 7 as window_no from a)""") + """select source, window_no, count(*) as total_articles,
            sum(tb) / count(*) as avg_title_length, sum(db) / count(*) as avg_description_length,
            min(ts) as first_article_at, max(ts) as last_article_at, count(*) = 7 as closed from n group by all""",
        "count_windows_all": with_(A, """n as (select *, (row_number() over (order by ts, doc_id) - 1) // 50
            as window_no from a)""") + """select window_no, count(*) as total_articles,
            count(distinct source) as sources_count, sum(tb) / count(*) as avg_title_length,
            sum(db) / count(*) as avg_description_length, min(ts) as first_article_at, max(ts) as last_article_at,
            count(*) = 50 as closed from n group by all""",
        "forced_close_windows": with_(A, HOURLY, """n as (select *, (row_number() over (partition by window_start
            order by ts, doc_id) - 1) // 3 as part from m)""") + f"""select {W}, part, count(*) as total_articles,
            count(distinct source) as sources_count, sum(tb) / count(*) as avg_title_length,
            sum(db) / count(*) as avg_description_length, min(ts) as first_article_at, max(ts) as last_article_at,
            count(*) = 3 as forced from n group by all""",
        "named_aggregators": with_(A, HOURLY, members(21_600, 3_600, "m6")) + """
            select 'hour' as aggregator, window_start, count(*) as total_articles, sum(tb) / count(*) as avg_title_length
              from m group by all
            union all select 'six_hours', window_start, count(*), sum(tc) / count(*) from m6 group by all""",
        "trailing_snapshots": with_(A, """b as (select epoch_us(min(ts)) as lo, epoch_us(max(ts)) as hi from a)""",
            """i as (select distinct make_timestamp(lo + (k * (hi - lo)) // 999) as t from b, range(1000) r(k))""") + """
            select count(ts) as total_articles, count(distinct source) as sources_count,
              case when count(ts) > 0 then sum(tc) / count(ts) else 0 end as avg_title_length,
              case when count(ts) > 0 then sum(dc) / count(ts) else 0 end as avg_description_length,
              count(ts) / 360e0 as rate_per_min, t - interval 6 hour as window_start, t as window_end
            from i left join a on ts >= t - interval 6 hour and ts <= t group by t""",
        "trailing_snapshot": with_(A, "n as (select max(ts) as t from a)") + """
            select count(*) as total_articles, count(distinct source) as sources_count,
              sum(tc) / count(*) as avg_title_length, sum(dc) / count(*) as avg_description_length,
              count(*) / 360e0 as rate_per_min, min(t) - interval 6 hour as window_start, min(t) as window_end
            from a, n where ts >= t - interval 6 hour""",
        "trailing_sources": with_(A) + """select source, count(*) as n from a
            where ts >= (select max(ts) from a) - interval 12 hour group by all""",
        "source_distribution": with_(A) + "select source, count(*) as n from a group by all order by n desc, source",
        "top_source": with_(A, "s as (select source, count(*) as n from a group by all)") + """
            select count(*) as total_sources, first(source order by n desc, source) as top_source,
              max(n) as top_count from s""",
        "top_sources_other": with_(A, """s as (select source, count(*) as n,
            row_number() over (order by count(*) desc, source) as rn from a group by source)""") + """
            select case when rn <= 8 then source else 'Other' end as source, sum(n)::bigint as n, rn > 8 as is_other
            from s group by all""",
        "validate_titles": with_(A) + f"""select doc_id, {TITLE} as title,
            case when {TITLE} = '' then 'Title is empty or too short'
              when strlen({TITLE}) > 500 then 'Title is too long (max 500 characters)' end as error from a""",
        "validate_links": f"""select page_id, case page_id % 6 when 2 then 'Invalid URL: ftp' || url
            when 5 then 'Invalid URL:  ' || url end as error,
            case when page_id % 6 not in (2, 5) then {PAGE_LINK} end as link from pages""",
        "sanitize_pages": f"select page_id, {SANITIZE.format(c='html')} as text from pages",
        "validate_descriptions": f"""select page_id, strlen(t) as n_bytes,
            case when strlen(t) > 5000 then 'Description is too long (max 5000 characters)' end as error
            from (select page_id, {SANITIZE.format(c='html')} as t from pages)""",
        "parse_dates": f"select event_id, {STRICT.format(id='event_id', ts='ts')} as parsed from events",
        "parse_dates_lenient": f"select event_id, {LENIENT.format(id='event_id', ts='ts')} as parsed from events",
        "rfc3339_texts": f"""select event_id, {RFC.format(t='t')} as text from (select event_id,
            case when event_id % 2 = 0 then date_trunc('second', ts) else ts end as t from events)""",
        "validation_verdicts": with_(A, VERDICTS) + f"""select doc_id, error is null as success, code as error_code,
            error, case when error is null then t end as title, case when error is null then link end as link,
            case when error is null then {RFC.format(t='moment')} end as published,
            case when error is null then strlen(body) else 0 end as desc_bytes from v2""",
        "valid_and_invalid": with_(A, VERDICTS) + "select doc_id, source_type, code as error_code from v2",
        "verdicts_without_source": with_(A, VERDICTS) + """select doc_id,
            coalesce(code, case when doc_id % 6 = 5 then 'source_empty' end) as error_code,
            coalesce(error, case when doc_id % 6 = 5 then 'Field validation failed: Source cannot be empty' end) as error from v2""",
        "verdict_messages": with_(A, VERDICTS) + """select doc_id, case when error is null then 'true' else 'false' end
            as success, error, case when error is null then link end as link from v2""",
        "validation_summary": with_(A, VERDICTS) + """select coalesce(code, 'valid') as outcome, count(*) as n
            from v2 group by all""",
        "stage_counters": with_(A, VERDICTS) + """select count(*) as scraped, count(*) filter (error is null) as validated,
            count(*) filter (error is not null) as validation_errors from v2""",
        "history_slice": history + f"""select {W}, total_articles, sources_count, rate_per_min from h
            where window_start >= (select max(window_start) from h) - interval 24 hour
            order by window_start desc limit 100""",
        "moving_average": history + """select window_start, total_articles,
            case when count(*) over w = 5 and count(*) over () > 5 then avg(total_articles) over w end as moving_avg
            from h window w as (order by window_start rows between 2 preceding and 2 following)""",
        "trend": history + """, r as (select total_articles, row_number() over (order by window_start desc) as rn from h),
            g as (select avg(total_articles) filter (rn <= 6) as recent_avg,
              avg(total_articles) filter (rn between 7 and 12) as older_avg from r),
            p as (select *, (recent_avg - older_avg) / older_avg * 100 as pct from g)
            select case when pct > 10 then 'strong_increase' when pct > 2 then 'moderate_increase'
              when pct < -10 then 'strong_decrease' when pct < -2 then 'moderate_decrease' else 'stable' end as trend,
              abs(pct) as trend_pct, recent_avg, older_avg from p""",
        "heatmap": history + """select window_start::date as day, hour(window_start)::int as hour,
            sum(total_articles)::bigint as articles from h group by all""",
        "rate_reference": history + """select window_start, rate_per_min,
            round((select avg(rate_per_min) from h), 6) as mean_rate from h""",
        "last_windows": history + "select window_start, total_articles from h order by window_start desc limit 100",
        "list_windows": with_(A, HOURLY) + f"select {W}, count(*) as article_count from m group by all",
        "window_by_source": with_(A, HOURLY, f"s as ({stats('bytes', 60)})",
            "c as (select window_start, source, count(*) as n from m group by all)") + f"""
            select s.window_start, window_end, total_articles::int as total_articles, rate_per_sec as publishing_rate,
              avg_title_length, avg_description_length as avg_desc_length, c.source, c.n::int as source_count
            from s join c on s.window_start = c.window_start""",
        "stored_windows_range": with_(A, HOURLY, f"s as ({stats('bytes', 60)})") + f"""
            select {W}, total_articles::int as total_articles, rate_per_sec as publishing_rate, avg_title_length,
              avg_description_length as avg_desc_length from s
            where window_start >= TIMESTAMP '2024-01-01 06:00:00' and window_end <= TIMESTAMP '2024-01-02 12:00:00'""",
        "stored_results": " union all ".join("(" + with_(A, m, KEYS, COUNTS) + f"""select {W}, '{name}' as analysis_type,
            sum(n) filter (kind = 'source')::bigint as total_articles,
            coalesce(max(n) filter (kind = 'source' and key = 'src3'), 0) as from_src3,
            max(n) filter (kind = 'keyword') as best_frequency from counts group by all)"""
            for m, name in ((HOURLY, "sliding_window"), (members(86_400, 86_400), "daily"))),
        "retained_windows": with_(A, HOURLY, """
            w as (select window_start, window_end, count(*) as total_articles, count(distinct source) as sources_count
              from m group by all),
            days as (select window_start::date as day, count(*) as n from w group by all),
            kept as (select day, coalesce(sum(n) over (order by day desc rows between unbounded preceding and 1 preceding), 0)
              as newer from days)""") + """
            select w.* from w join kept on window_start::date = day where newer < 30""",
        "routed_feeds": """select doc_id, 'https://x.test/' || doc_id as link, null::varchar as error
              from documents, range(2) where doc_id % 7 not in (3, 5)
            union all select doc_id, null, 'the feed is not well formed' from documents where doc_id % 7 in (3, 5)""",
        "newest_runs": with_(SAMPLES) + """select scraper, iteration, sum(sec) as execution_time_seconds,
            min(cpu) as avg_cpu_percent, max(mem) as max_memory_mb from s where iteration < 100 group by all""",
        "html_articles": f"""select page_id, 0 as pos, {PAGE_TITLE} as title, url as link, 'html' as source_type
            from pages where {PAGE_TITLE} <> ''""",
        "html_articles_strict": f"""select page_id, 0 as pos, {PAGE_TITLE} as title,
            regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/story?a=1&b=2' as link, 'html' as source_type
            from pages where {PAGE_TITLE} <> ''""",
        "html_articles_nested": f"""select page_id, k::int as pos, {PAGE_TITLE} as title, url as link,
            'html' as source_type from pages, range(2) t(k) where {PAGE_TITLE} <> ''""",
        "html_articles_promo": f"""with n as (select *, page_id % 12 + 1 as n from pages)
            select page_id, (k - 1)::int as pos, 'Café ' || k || ' — ' || page_id as title,
              regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/p/' || k as link, 'html' as source_type
            from n, range(1, 11) t(k) where k <= n
            union all select page_id, n::int, {PAGE_TITLE}, url, 'html' from n where n < 10 and {PAGE_TITLE} <> ''""",
        "rss_articles": with_(A) + rss.format(
            authors="source_type || ',desk'", categories="lang || ',' || event_type")
            + " union all select source, 'more', link || '/more', 0, '', '', null, 'rss' from a",
        "rss_files": "select * exclude source from (" + with_(A) + rss.format(
            authors="source_type || ',desk'", categories="lang || ',' || event_type")
            + " union all select source, 'more', link || '/more', 0, '', '', null, 'rss' from a)",
        "atom_articles": with_(A) + rss.format(authors="source_type", categories="lang"),
        "decode_messages": with_(A) + """select 'news-articles' as topic, (doc_id % 4)::int as partition,
            doc_id as offset, source, title, link, lang || ',' || event_type as categories,
            ts as scraped_at from a where doc_id % 10 <> 3""",
        "labelled_categories": key_counts(HOURLY, "'category'"),
        "callback_before_windows": with_(A, HOURLY) + f"""select {W}, 'source' as kind, upper(source) as key,
            count(*) as n from m where doc_id % 10 <> 3 and event_type <> 'click' group by all""",
        "dead_letters": with_(A) + """select (doc_id % 4)::int as partition, doc_id as offset from a
            where doc_id % 10 = 3""",
        "kafka_rows": with_(A) + """select 'news-articles' as topic, source as key, 'source=' || source as header_1,
            'source_type=' || source_type as header_2, link, title, event_type as category from a""",
        "json_store_append": with_(A) + """select source, title, link, lang || ',' || event_type as categories,
            ts as scraped_at from a, range(2)""",
        "json_array_files": with_(A) + """select source, title, link, lang || ',' || event_type as categories,
            ts as scraped_at from a""",
        "active_workers": f"""select 'w' || user_id as id, max(ts) as last_heartbeat,
            max_by(event_type, (ts, event_type)) as status from events group by user_id
            having epoch_us((select max(ts) from events)) - epoch_us(max(ts)) < {2 * LIMIT_S}000000""",
        "available_sources": with_(LOCKS) + "select url from l where url not in (select url from held)",
        "sources_to_scrape": with_(LOCKS) + "select url, name, type from c where url not in (select url from held)",
        "without_locked": with_(LOCKS) + "select url, name, type from c where url not in (select url from held)",
        "run_usage": with_(SAMPLES) + """select scraper, iteration,
            coalesce(sum(cpu) filter (cpu > 0) / count(*) filter (cpu > 0), 0) as avg_cpu_percent,
            coalesce(max(cpu) filter (cpu > 0), 0) as max_cpu_percent,
            coalesce(sum(mem) filter (mem > 0) / count(*) filter (mem > 0), 0) as avg_memory_mb,
            coalesce(max(mem) filter (mem > 0), 0) as max_memory_mb from s group by all""",
        "run_summary": with_(RUNS) + "select * from u",
        "run_comparison": with_(COMPARED) + """select metric, case metric
            when 'avg_execution_time' then 'Execution Time (seconds)'
            when 'avg_cpu_across_runs' then 'Average CPU Usage (%)' when 'avg_max_cpu' then 'Max CPU Usage (%)'
            when 'avg_memory_across_runs' then 'Average Memory (MB)' else 'Max Memory (MB)' end as display_name,
            baseline, candidate, candidate - baseline as difference,
            (candidate - baseline) / baseline * 100 as difference_percent, baseline / candidate as improvement_ratio,
            case when baseline / candidate > 1 then 'view' when baseline / candidate < 1 then 'click'
              else 'equal' end as better from cmp""",
        "run_tally": with_(COMPARED) + """, t as (select count(*) filter (baseline / candidate > 1.1e0) as c,
            count(*) filter (baseline / candidate < 0.9e0) as b, count(*) as n from cmp)
            select c as candidate_advantages, b as baseline_advantages, n - c - b as comparable,
              case when c > b then 'view' when b > c then 'click' else 'comparable' end as overall from t""",
        "histogram_buckets": """with b as (select 1e0 + 10 * k as le from range(20) t(k) union all select null),
            e as (select distinct event_type from events)
            select e.event_type, b.le, (select count(*) from events x where x.event_type = e.event_type
              and (b.le is null or x.value <= b.le)) as n from e, b""",
        "stream_tumbling_stats": hour_stats,
        "stream_sliding_stats": slide_stats,
        "stream_top_keywords": six_keys + f"select {W}, key as word, n as frequency, rank from best",
        "stream_count_windows": with_(A, """n as (select *, (doc_id % 4)::int as shard,
              (row_number() over (partition by source, doc_id % 4 order by ts, doc_id) - 1) // 7 as window_no from a)""",
            """g as (select source, shard, window_no, count(*) as total_articles, sum(tb) / count(*) as avg_title_length,
              sum(db) / count(*) as avg_description_length, min(ts) as first_article_at, max(ts) as last_article_at,
              count(*) = 7 as closed from n group by all)""") + """select *, closed and epoch_us(last_article_at) <=
              (select (epoch_ms(max(ts)) - 60000) * 1000 from a) as by_stream from g""",
        "stream_named_aggregators": with_(A, HOURLY, members(21_600, 3_600, "m6")) + """
            select 'hour' as aggregator, window_start, count(*) as total_articles, sum(tb) / count(*) as avg_title_length
              from m group by all
            union all select 'six_hours', window_start, count(*), sum(tc) / count(*) from m6 group by all""",
        "stream_capped_windows": with_(A, SIX, """c as (select *, count(*) over (partition by window_start) as arrived from m
            qualify row_number() over (partition by window_start order by ts desc, doc_id desc) <= 5)""") + f"""
            select {W}, count(distinct source) as sources_count, sum(tc) / count(*) as avg_title_length,
              sum(dc) / count(*) as avg_description_length, count(*) / 360e0 as rate_per_min, max(ts) as last_article_at,
              arrived, count(*) as kept, arrived - count(*) as dropped from c group by {W}, arrived""",
        "stream_running_windows": with_(A, SIX, """v as (select m.*, run from m, range(3) t(run) where doc_id % 3 <= run)""",
            f"""s as (select {W}, run, count(*) as total_articles, count(distinct source) as sources_count,
              sum(tc) / count(*) as avg_title_length, sum(dc) / count(*) as avg_description_length,
              count(*) / 360e0 as rate_per_min, max(ts) as last_article_at from v group by {W}, run
              having count(*) filter (doc_id % 3 = run) > 0)""") + """
            select * exclude run, (row_number() over (partition by window_start order by run))::int as version,
              run = max(run) over (partition by window_start) as latest from s""",
        "stream_unique_links": with_(A) + "select distinct lang || '/' || ts::date as link from a",
        "stream_delivery": with_(A) + "select doc_id, source, link from a",
        "stream_delivery_taken": with_(A) + """select doc_id, source, link, place from a,
            (values ('topic'), ('backup')) t(place)""",
        "stream_delivery_rows": with_(A) + "select doc_id, source, link from a where doc_id % 3 = 0",
        "stream_fan_out": with_(A) + """select doc_id, source, link, place from a,
            (values ('table'), ('json')) t(place)""",
        # late rows count in windows that end after the watermark the first run left
        "stream_late_rows": with_(A, FIVE, """k as (select * from m where doc_id % 10 <> 7 or window_end >
            (select max(ts) from a where doc_id % 10 <> 7) - interval 1 minute)""") + stats("chars", 5, "k"),
        "module_statistics": with_(A, """w as (select source,
            len(regexp_extract_all(description, '\\S+')) as n from a)""") + """
            select source, count(*) as articles, sum(n)::bigint as words, max(n) as longest from w group by all""",
        "word_count_distribution": with_(A, """w as (select
            len(regexp_extract_all(description, '\\S+')) as n from a)""") + """
            select n // 100 * 100 as words_from, count(*) as n from w group by 1""",
        "emerging_keywords": with_(A, HOURLY, KEYS, COUNTS).rstrip() + emerging.format(kind="keyword"),
        "source_sentiment": with_(A, """aw as (select text_id, source,
              unnest(regexp_extract_all(lower(title), '\\S+')) as word from a)""", """lex as (select word,
              case when sum(quality * 2 - 1) > 0 then 1e0 else -1e0 end as weight
              from aw join labels on labels.doc_id = text_id group by word)""") + """
            select a.source, count(*) as articles, coalesce(any_value(s.n), 0) as scored_words,
              coalesce(any_value(s.score), 0e0) / count(*) as mean_sentiment
            from a left join (select source, count(*) as n, sum(weight) as score from aw join lex using (word)
              group by source) s using (source) group by a.source""",
        "source_popularity": with_(A, HOURLY, KEYS, COUNTS).rstrip() + emerging.format(kind="source"),
    }
