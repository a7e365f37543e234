"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the meaning of each result, not from the Spark code: the
logical tables are inlined as CTEs over the raw driver tables.
"""

from __future__ import annotations

VIEWS = {
    "cities": """select cast(n_nationkey as bigint) city_id, n_name city_name, replace(r_name, ' ', '_') area
  from nation join region on n_regionkey = r_regionkey""",
    "users": """select c_custkey user_id, concat('user_', c_custkey) username, c_name "name",
         cast(10 + c_custkey % 50 as int) age, c_mktsegment professional,
         case when c_custkey % 2 = 0 then 'M' else 'F' end gender
  from customer""",
    "products": """select p_partkey product_id, p_name product_name, p_brand extend_info from part""",
    "uva": """select d "date", user_id, concat(user_id, '_', d) session_id, k % 10 + 1 page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') action_time,
         case when event_type = 'error' then concat('kw', k % 6) end search_keyword,
         case when event_type in ('click', 'view') then k % 20 + 1 else -1 end click_category_id,
         case when event_type in ('click', 'view') then event_id % 40 else -1 end click_product_id,
         case when event_type = 'purchase' then concat_ws(',', k % 20 + 1, case when event_id % 2 = 0 then (k + 7) % 20 + 1 end) end order_category_ids,
         case when event_type = 'purchase' then concat_ws(',', k % 40, (k + 1) % 40) end order_product_ids,
         case when event_type = 'signup' then concat_ws(',', k % 20 + 1, case when event_id % 3 = 0 then (k + 3) % 20 + 1 end) end pay_category_ids,
         case when event_type = 'signup' then concat_ws(',', k % 40, (k + 2) % 40) end pay_product_ids,
         user_id % 25 city_id, event_id
  from (select *, cast(json_extract_string(props, '$.k') as bigint) k, strftime(ts, '%Y-%m-%d') d from events)""",
    "ads": """select epoch_us(ts) // 1000 "timestamp", area, city_name city, cast(user_id as varchar) userid,
         cast(cast(json_extract_string(props, '$.k') as bigint) % 6 + 1 as varchar) adid, event_id
  from events join cities on user_id % 25 = city_id""",
    "ad_lines": """select concat_ws(' ', "timestamp", area, city, userid, adid) line, event_id from ads""",
    "kafka_rows": """select 'ads_log' topic, cast(event_id % 3 as int) "partition", event_id // 3 "offset",
         line "value" from ad_lines""",
}
ORDER = ["cities", "users", "products", "uva", "ads", "ad_lines", "kafka_rows"]
_DEPS = {"ads": ["cities"], "ad_lines": ["cities", "ads"], "kafka_rows": ["cities", "ads", "ad_lines"]}


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the logical-table CTEs it mentions (plus ``extra``)."""
    text = body + " " + " ".join(s for _, s in (extra or []))
    need = set()
    for v in ORDER:
        if _mentions(text, v):
            need.add(v)
            need.update(_DEPS.get(v, []))
    ctes = [(v, VIEWS[v]) for v in ORDER if v in need] + list(extra or [])
    if not ctes:
        return body
    return "with " + ",\n".join(f"{n} as ({s})" for n, s in ctes) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b(from|join)\s+{name}\b", text) is not None


TASK = "mallscope-task"
T = 3          # blacklist threshold of the test model
BATCH_MS = 8 * 86_400_000     # a batch of the micro-batch stream test
SPAN = 360     # trend span used on the test tables (about one click in four minutes)

FILTERED = """select a.* from uva a join users u on a.user_id = u.user_id
  where a."date" >= '2024-01-05' and a."date" <= '2024-01-25' and u.age >= 20 and u.age <= 50"""

CATEGORY_EVENTS = """select cast(click_category_id as varchar) category_id, 'click' kind from f where click_category_id <> -1
  union all select unnest(string_split(order_category_ids, ',')), 'order' from f
    where click_category_id = -1 and order_category_ids is not null
  union all select unnest(string_split(pay_category_ids, ',')), 'pay' from f
    where click_category_id = -1 and order_category_ids is null and pay_category_ids is not null"""

PIVOT = """select category_id, count(*) filter (where kind = 'click') click_count,
    count(*) filter (where kind = 'order') order_count, count(*) filter (where kind = 'pay') pay_count
  from e where category_id <> '' group by category_id"""

TOP10 = "select * from p order by pay_count desc, order_count desc, click_count desc, category_id limit 10"

TRANSITIONS = """select session_id, action_time, event_id, page_id,
    lead(page_id) over (partition by session_id order by action_time, event_id) next_page_id from uva"""

FLOW = "select * from (values ('1','2'), ('2','3'), ('3','4'), ('4','5'), ('5','6'), ('6','7')) v(from_page, to_page)"

JUMPS = """select cast(t.page_id as varchar) from_page, cast(t.next_page_id as varchar) to_page,
    concat(t.page_id, '-', t.next_page_id) jump, count(*) n
  from t join flow on cast(t.page_id as varchar) = flow.from_page and cast(t.next_page_id as varchar) = flow.to_page
  group by all"""

VIEWS_N = """select cast(page_id as varchar) page, count(*) n from uva
  where cast(page_id as varchar) in ('1','2','3','4','5','6') group by all"""

AREA_COUNTS = """select c.area, p.product_name, c.city_name, count(*) n
  from uva u join cities c on u.city_id = c.city_id join products p on u.click_product_id = p.product_id
  group by all"""

SHARES = """select *, sum(n) over (partition by area, product_name) ct,
      row_number() over (partition by area, product_name order by n desc, city_name) rn from ac"""

SHARE_TEXT = """select area, product_name, cast(max(ct) as bigint) product_count,
    concat(string_agg(concat(coalesce(city_name, 'null'), ':', cast(pct as varchar), '%'), ',' order by rn),
           ',其他:', cast(floor((100.0 - max(case when rn = 1 then pct end) - coalesce(max(case when rn = 2 then pct end), 0.0)) * 10 + 0.5) / 10 as varchar), '%') city_click_ratio
  from (select *, floor(n * cast(1000 as double) / ct + 0.5) / 10 pct from sh where rn <= 2) s
  group by area, product_name"""

DAY = "strftime(make_timestamp(\"timestamp\" * 1000), '%Y-%m-%d')"

BLOCKS = f"""select userid, min({{'ts': "timestamp", 'eid': event_id}}) bp from (
    select *, row_number() over (partition by {DAY}, userid, adid order by "timestamp", event_id) rn from ads)
  where rn = {T} group by userid"""

KEPT = """select a.* from ads a left join b on a.userid = b.userid
  where b.userid is null or a."timestamp" < b.bp.ts or (a."timestamp" = b.bp.ts and a.event_id <= b.bp.eid)"""

R6 = f"""select {DAY} "date", area, city, adid, count(*) n from kept group by all"""
ROLLUP = """select "date", area, adid, cast(sum(n) as bigint) n from r6 group by all"""
RANKED = """select * from (select *, cast(row_number() over (partition by "date", area order by n desc, adid) as integer) rn
  from ro) where rn <= 3"""
MINUTES = f"""select adid, "timestamp" // 60000 as "minute", count(*) n,
    strftime(make_timestamp(("timestamp" // 60000) * 60000000), '%H:%M') hhmm
  from kept where "timestamp" // 60000 > (select max("timestamp" // 60000) from kept) - {SPAN}
  group by adid, "timestamp" // 60000"""


def _blk():
    return [("b", BLOCKS), ("kept", KEPT)]


def _micro_batch(ms: int) -> str:
    return with_views(
        """select a."timestamp", a.area, a.city, a.userid, a.adid, a.event_id
           from a left join mb on a.userid = mb.userid where mb.userid is null or a.batch <= mb.bb""",
        [("a", f'select *, "timestamp" // {ms} batch from ads'),
         ("mb", f"""select userid, min(batch) bb from (
                      select *, row_number() over (partition by {DAY}, userid, adid
                                                   order by batch, "timestamp", event_id) rn from a)
                    where rn = {T} group by userid""")])


LEVELS = """select case when grouping(session_id) = 1 then 'category' else 'session' end "level", category_id, session_id,
    count(*) filter (where kind = 'click') click_count, count(*) filter (where kind = 'order') order_count,
    count(*) filter (where kind = 'pay') pay_count
  from es where category_id <> '' group by grouping sets ((category_id), (category_id, session_id))"""

SESSION_EVENTS = """select session_id, cast(click_category_id as varchar) category_id, 'click' kind from f where click_category_id <> -1
  union all select session_id, unnest(string_split(order_category_ids, ',')), 'order' from f
    where click_category_id = -1 and order_category_ids is not null
  union all select session_id, unnest(string_split(pay_category_ids, ',')), 'pay' from f
    where click_category_id = -1 and order_category_ids is null and pay_category_ids is not null"""

# the bounds of the condition sets, and what each set keeps (counted per day and age first)
SETS = """select s_suppkey set_id, case when s_suppkey % 7 <> 0 then printf('2024-01-%02d', 1 + s_suppkey % 20) end lo_d,
    case when s_suppkey % 5 <> 0 then printf('2024-01-%02d', 5 + s_suppkey % 25) end hi_d,
    case when s_suppkey % 3 <> 0 then 10 + s_suppkey % 30 end lo_a,
    case when s_suppkey % 4 <> 0 then 20 + s_suppkey % 40 end hi_a from supplier"""
DAY_AGE = """select age, "date", category_id, count(*) filter (where kind = 'click') c,
    count(*) filter (where kind = 'order') o, count(*) filter (where kind = 'pay') p
  from es where category_id <> '' group by all"""
SET_COUNTS = """select set_id, category_id, cast(sum(c) as bigint) click_count, cast(sum(o) as bigint) order_count,
    cast(sum(p) as bigint) pay_count
  from sets join da on (lo_d is null or "date" >= lo_d) and (hi_d is null or "date" <= hi_d)
    and (lo_a is null or age >= lo_a) and (hi_a is null or age <= hi_a)
  group by set_id, category_id"""


def _sets():
    events = SESSION_EVENTS.replace("select session_id,", 'select age, "date",')
    return [("f", 'select a.*, u.age from uva a join users u on a.user_id = u.user_id'), ("es", events),
            ("da", DAY_AGE), ("sets", SETS), ("sc", SET_COUNTS)]


REJECTS = """select line, event_id from (
    select event_id, case when event_id % 97 = 0 then array_to_string(string_split(line, ' ')[1:3], ' ')
                          when event_id % 101 = 0 then concat('time', line) end line from ad_lines)
  where line is not null"""


def oracle_sql() -> dict[str, str]:
    q = {}
    q["load_table"] = "select c_custkey, c_name, cast(c_nationkey as bigint) c_nationkey from customer"
    q["conform"] = """select event_id, cast(user_id as int) user_id, event_type, cast(null as varchar) note from events"""
    q["filter_actions"] = with_views(FILTERED)
    q["classify_action"] = with_views("""select event_id,
        case when click_category_id <> -1 then 'click' when order_category_ids is not null then 'order'
             when pay_category_ids is not null then 'pay' end kind,
        case when click_category_id <> -1 then cast(click_category_id as varchar)
             when order_category_ids is not null then order_category_ids
             when pay_category_ids is not null then pay_category_ids end category_list
      from uva""")
    q["explode_ids"] = with_views("""select event_id, id from (select event_id, unnest(string_split(order_category_ids, ',')) id
      from uva where order_category_ids is not null) where id <> ''""")
    q["category_action_counts"] = with_views(
        "select category_id, kind, count(*) n from e where category_id <> '' group by all",
        [("f", FILTERED), ("e", CATEGORY_EVENTS)])
    q["category_pivot"] = with_views("select * from p", [("f", FILTERED), ("e", CATEGORY_EVENTS), ("p", PIVOT)])
    q["with_task_id"] = with_views(f"select '{TASK}' task_id, * from p",
                                   [("f", FILTERED), ("e", CATEGORY_EVENTS), ("p", PIVOT)])
    q["hot_category_top10"] = with_views(
        f"select '{TASK}' task_id, category_id, click_count, order_count, pay_count from top",
        [("f", FILTERED), ("e", CATEGORY_EVENTS), ("p", PIVOT), ("top", TOP10)])
    q["category_session_counts"] = with_views(
        """select cast(click_category_id as varchar) category_id, session_id, count(*) click_count
           from f where click_category_id <> -1 group by all""", [("f", FILTERED)])
    q["hot_category_top_sessions"] = with_views(
        f"""select '{TASK}' task_id, category_id, session_id, click_count from (
              select *, row_number() over (partition by category_id order by click_count desc, session_id) rn from n)
            where rn <= 10""",
        [("f", FILTERED), ("e", CATEGORY_EVENTS), ("p", PIVOT), ("top", TOP10),
         ("n", """select cast(click_category_id as varchar) category_id, session_id, count(*) click_count from f
                  where cast(click_category_id as varchar) in (select category_id from top) group by all""")])
    q["keep_in"] = with_views("select event_id, page_id from uva where page_id in (1, 2, 3)")
    q["session_transitions"] = with_views(TRANSITIONS)
    q["page_view_counts"] = with_views(VIEWS_N)
    q["page_jump_counts"] = with_views("select * from j", [("t", TRANSITIONS), ("flow", FLOW), ("j", JUMPS)])
    q["page_jump_ratio"] = with_views(
        f"""select '{TASK}' task_id, j.jump, cast(j.n as double) / coalesce(v.n, 1) ratio
            from j left join v on j.from_page = v.page""",
        [("t", TRANSITIONS), ("flow", FLOW), ("j", JUMPS), ("v", VIEWS_N)])
    q["jump_ratio"] = with_views(
        "select j.jump, cast(j.n as double) / coalesce(v.n, 1) ratio from j left join v on j.from_page = v.page",
        [("t", TRANSITIONS), ("flow", FLOW), ("j", JUMPS), ("v", VIEWS_N)])
    q["click_star_join"] = with_views(
        """select c.area, p.product_name, c.city_name from uva u join cities c on u.city_id = c.city_id
           join products p on u.click_product_id = p.product_id""")
    q["area_product_counts"] = with_views(
        "select area, product_name, cast(sum(n) as bigint) product_count from ac group by all",
        [("ac", AREA_COUNTS)])
    q["top_share_text"] = with_views("select * from st", [("ac", AREA_COUNTS), ("sh", SHARES), ("st", SHARE_TEXT)])
    q["area_product_rank"] = with_views(
        """select area, product_name, product_count, rk from (
             select *, cast(rank() over (partition by area order by product_count desc) as integer) rk from (
               select area, product_name, cast(sum(n) as bigint) product_count from ac group by area, product_name))
           where rk <= 3""",
        [("ac", AREA_COUNTS)])
    q["area_product_top3"] = with_views(
        f"""select '{TASK}' task_id, area, product_name, product_count, city_click_ratio from (
              select *, rank() over (partition by area order by product_count desc) rk from st) where rk <= 3""",
        [("ac", AREA_COUNTS), ("sh", SHARES), ("st", SHARE_TEXT)])
    q["render_ad_log"] = with_views("select line, event_id from ad_lines")
    q["parse_ad_log"] = with_views("""select cast(split_part(line, ' ', 1) as bigint) "timestamp", split_part(line, ' ', 2) area,
        split_part(line, ' ', 3) city, split_part(line, ' ', 4) userid, split_part(line, ' ', 5) adid, event_id from ad_lines""")
    q["offset_ranges"] = with_views(
        """select topic, "partition", min("offset") from_offset, max("offset") + 1 until_offset, count(*) n
           from kafka_rows group by all""")
    q["user_ad_daily_counts"] = with_views(f"""select {DAY} "date", userid, adid, count(*) n from ads group by all""")
    q["blacklist_users"] = with_views("select userid, bp.ts blocked_ts, bp.eid blocked_event_id from b",
                                      [("b", BLOCKS)])
    q["blacklist_filter"] = with_views("select * from kept", _blk())
    q["blacklist_filter_micro_batch"] = _micro_batch(3000)
    q["stream_blacklist_micro_batch"] = _micro_batch(BATCH_MS)
    q["drop_in"] = with_views("select * from ads where userid not in (select userid from b)", [("b", BLOCKS)])
    q["date_area_city_ad_count"] = with_views("select * from r6", _blk() + [("r6", R6)])
    q["kv_key"] = with_views(
        """select concat('date_area_city_ad_', "date") hash_key, concat_ws(':', area, city, adid) field,
                  cast(n as varchar) "value" from r6""", _blk() + [("r6", R6)])
    q["date_area_ad_rollup"] = with_views("select * from ro", _blk() + [("r6", R6), ("ro", ROLLUP)])
    q["top3_ads_by_area"] = with_views("select * from rk", _blk() + [("r6", R6), ("ro", ROLLUP), ("rk", RANKED)])
    q["top3_ads_json"] = with_views(
        """select "date", area, concat('[', string_agg(concat('{"', adid, '":', n, '}'), ',' order by rn), ']') top3_json
           from rk group by all""", _blk() + [("r6", R6), ("ro", ROLLUP), ("rk", RANKED)])
    q["ad_minute_counts"] = with_views("select * from mc", _blk() + [("mc", MINUTES)])
    q["ad_minute_json"] = with_views(
        """select adid, concat('[', string_agg(concat('{"', hhmm, '":', n, '}'), ',' order by "minute"), ']') minutes_json
           from mc group by adid""", _blk() + [("mc", MINUTES)])
    q["top3_ads_kv"] = with_views(
        """select concat('top3_ads_per_day:', "date") hash_key, area field,
                  concat('[', string_agg(concat('{"', adid, '":', n, '}'), ',' order by rn), ']') "value"
           from rk group by "date", area""", _blk() + [("r6", R6), ("ro", ROLLUP), ("rk", RANKED)])
    q["ad_minute_kv"] = with_views(
        """select 'last_hour_ads_click' hash_key, adid field,
                  concat('[', string_agg(concat('{"', hhmm, '":', n, '}'), ',' order by "minute"), ']') "value"
           from mc group by adid""", _blk() + [("mc", MINUTES)])
    q["stream_rejects"] = with_views(REJECTS)
    q["stream_blacklist_users"] = q["blacklist_users"]
    q["stream_user_ad_daily_counts"] = with_views(
        f"""select {DAY} "date", userid, adid, count(*) n from kept group by all""", _blk())
    q["category_levels"] = with_views("select * from lv", [("f", FILTERED), ("es", SESSION_EVENTS), ("lv", LEVELS)])
    q["condition_set_counts"] = with_views("select * from sc", _sets())
    q["condition_set_top10"] = with_views(
        """select * from (select *, cast(row_number() over (partition by set_id
             order by pay_count desc, order_count desc, click_count desc, category_id) as int) place from sc)
           where place <= 10""", _sets())
    q["sql_functions"] = with_views(
        f"""select {DAY} "date", strftime(make_timestamp("timestamp" * 1000), '%H:%M') hhmm, adid, event_id,
                  floor(cast(event_id as double) * 1000 / (event_id + 7) + 0.5) / 10 share,
                  floor(event_id / cast(7 as double) * 10 + 0.5) / 10 tenth, cast(2 as int) n_ids from ads""")
    q["area_product_top3_sql"] = q["area_product_top3"]
    q["hot_category_top10_one_pass"] = q["hot_category_top10"]
    q["hot_category_top_sessions_one_pass"] = q["hot_category_top_sessions"]
    q["hot_category_top10_partitioned"] = q["hot_category_top10"]
    q["stream_blacklist_filter"] = q["blacklist_filter"]
    q["checkpoint_restart"] = q["blacklist_filter"]
    q["stream_date_area_city_ad_count"] = q["date_area_city_ad_count"]
    q["stream_state_totals"] = q["date_area_city_ad_count"]
    q["stream_bounded_state"] = q["date_area_city_ad_count"]
    q["replace_table"] = q["date_area_city_ad_count"]
    q["stream_top3_ads_json"] = q["top3_ads_json"]
    q["replace_kv"] = q["top3_ads_json"]
    q["stream_ad_minute_counts"] = q["ad_minute_counts"]
    q["stream_ad_minute_json"] = q["ad_minute_json"]
    q["upsert_kv"] = q["kv_key"]
    q["stream_offset_ranges"] = q["offset_ranges"]
    return q
