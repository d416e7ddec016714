"""Oracle SQL: each registered query written again as plain SQL for DuckDB
over the same Parquet tables (views named after the tables).

The SQL is written independently from the DataFrame code – it restates the
meaning of each product – so agreement of the two is evidence for both.
"""

from __future__ import annotations

import datetime as _dt

from memberscope.functions.rules import as_rule
from memberscope.plans import catalog as C

AS_OF = _dt.date.fromisoformat(C.AS_OF)


def _d(days: int) -> str:
    """``DATE 'as_of - days'``."""
    return f"DATE '{(AS_OF - _dt.timedelta(days=days)).isoformat()}'"


def _ts(days: int) -> str:
    return f"TIMESTAMP '{(AS_OF - _dt.timedelta(days=days)).isoformat()} 00:00:00'"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

PHONE = "CASE WHEN c_acctbal >= 9000 THEN 'null' ELSE c_name END"
MEMBER = f"""
member AS (
  SELECT c_custkey AS id, {PHONE} AS phone, c_mktsegment AS sex,
         c_nationkey AS member_channel,
         CASE WHEN c_acctbal < 0 THEN 'null' ELSE c_name END AS mp_open_id,
         c_nationkey AS address_default_id, r.create_time
  FROM customer
  LEFT JOIN (SELECT user_id, min(ts) AS create_time FROM events
             WHERE event_type = 'signup' GROUP BY user_id) r
    ON r.user_id = c_custkey)"""

COUPON_MEMBER = f"""
coupon_member AS (
  SELECT user_id AS member_id, {K} AS coupon_id,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS coupon_channel,
         ts AS create_time
  FROM events)"""


def _tag_ctes(parity: bool = False) -> str:
    if parity:
        ob = """
ob AS (
  SELECT o.o_custkey AS memberId, count(o.o_orderkey) AS orderCount,
         strftime(max(o.o_orderdate), '%Y-%m-%d') AS orderTime,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS orderMoney,
         coalesce(list_sort(list(DISTINCT l.l_partkey)
           FILTER (WHERE l.l_partkey IS NOT NULL)), []) AS favGoods
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey)"""
        fc = f"""
fc AS (SELECT member_id AS memberId, strftime(create_time, '%Y-%m-%d') AS freeCouponTime
       FROM coupon_member WHERE coupon_id = {C.FREE_COUPON_ID})"""
    else:
        ob = """
ob0 AS (
  SELECT o_custkey AS memberId, count(o_orderkey) AS orderCount,
         strftime(max(o_orderdate), '%Y-%m-%d') AS orderTime,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS orderMoney
  FROM orders GROUP BY o_custkey),
goods AS (
  SELECT memberId, list(l_partkey ORDER BY l_partkey) AS favGoods
  FROM (SELECT DISTINCT o.o_custkey AS memberId, l.l_partkey
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE l.l_partkey IS NOT NULL)
  GROUP BY memberId),
ob AS (
  SELECT ob0.*, coalesce(goods.favGoods, []) AS favGoods
  FROM ob0 LEFT JOIN goods ON ob0.memberId = goods.memberId)"""
        fc = f"""
fc AS (SELECT member_id AS memberId, strftime(min(create_time), '%Y-%m-%d') AS freeCouponTime
       FROM coupon_member WHERE coupon_id = {C.FREE_COUPON_ID} GROUP BY member_id)"""
    return f"""WITH {MEMBER}, {COUPON_MEMBER},
base AS (
  SELECT id AS memberId, phone, sex, member_channel AS channel,
         mp_open_id AS subOpenId, address_default_id AS address,
         strftime(create_time, '%Y-%m-%d') AS regTime
  FROM member), {ob}, {fc},
ct AS (
  SELECT memberId, list(d ORDER BY d) AS couponTimes
  FROM (SELECT DISTINCT member_id AS memberId, strftime(create_time, '%Y-%m-%d') AS d
        FROM coupon_member WHERE coupon_id <> {C.FREE_COUPON_ID})
  GROUP BY memberId),
cm AS (
  SELECT cm.member_id AS memberId,
         CAST(sum(CAST(p.p_retailprice AS DECIMAL(18,2)) * 0.5) AS DECIMAL(38,3)) AS chargeMoney
  FROM coupon_member cm LEFT JOIN part p ON cm.coupon_id = p.p_partkey
  WHERE cm.coupon_channel <> 1 GROUP BY cm.member_id),
ot AS (
  SELECT o.o_custkey AS memberId,
         CAST(floor(epoch(max(l.l_shipdate))) AS BIGINT)
           - CAST(floor(epoch(max(o.o_orderdate))) AS BIGINT) AS overTime
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey),
fb AS (
  SELECT user_id AS memberId, arg_max({K} % 4 + 1, event_id) AS feedBack
  FROM events WHERE event_type = 'error' GROUP BY user_id),
tags AS (
  SELECT b.memberId, b.phone, b.sex, b.channel, b.subOpenId, b.address, b.regTime,
         ob.orderCount, ob.orderTime, ob.orderMoney, ob.favGoods,
         fc.freeCouponTime, ct.couponTimes, cm.chargeMoney, ot.overTime, fb.feedBack
  FROM base b
  LEFT JOIN ob ON b.memberId = ob.memberId
  LEFT JOIN fc ON b.memberId = fc.memberId
  LEFT JOIN ct ON b.memberId = ct.memberId
  LEFT JOIN cm ON b.memberId = cm.memberId
  LEFT JOIN ot ON b.memberId = ot.memberId
  LEFT JOIN fb ON b.memberId = fb.memberId)"""


TAG_TEXT_COLS = """memberId, phone, sex, channel, subOpenId, address, regTime,
  orderCount, orderTime, CAST(orderMoney AS DOUBLE) AS orderMoney,
  array_to_string(list_transform(favGoods, lambda x: CAST(x AS VARCHAR)), ',') AS favGoods,
  freeCouponTime, array_to_string(couponTimes, ',') AS couponTimes,
  CAST(chargeMoney AS DOUBLE) AS chargeMoney, overTime, feedBack"""

# Column types of the tag table, for typing rule literals like the Spark side.
TAG_TYPES = {
    "memberId": "BIGINT", "channel": "INTEGER", "address": "INTEGER",
    "orderCount": "BIGINT", "orderMoney": "DECIMAL(38,2)",
    "chargeMoney": "DECIMAL(38,3)", "overTime": "BIGINT", "feedBack": "INTEGER",
    "favGoods": "BIGINT",
}
TAG_ARRAYS = ("favGoods", "couponTimes")


def rule_sql(rule) -> str:
    """One rule as a SQL predicate over the ``tags`` CTE (same meaning as
    ``memberscope.functions.rules.compile_rule``; NULL counts as false)."""
    r = as_rule(rule)
    col, typ = r.name, TAG_TYPES.get(r.name)

    def lit(v):
        v = v.replace("'", "''")
        return f"TRY_CAST('{v}' AS {typ})" if typ else f"'{v}'"

    arr = col in TAG_ARRAYS
    if r.type == "exists":
        return f"({col} IS NOT NULL AND len({col}) > 0)" if arr else f"({col} IS NOT NULL)"
    if r.type in ("match", "notMatch"):
        hit = (f"coalesce(list_contains({col}, {lit(r.value)}), false)" if arr
               else f"coalesce({col} = {lit(r.value)}, false)")
        return hit if r.type == "match" else f"(NOT {hit})"
    if r.type == "rangeGte":
        return f"coalesce({col} >= {lit(r.value)}, false)"
    lo, hi = r.value.split("-", 1)
    return f"coalesce({col} >= {lit(lo.strip())} AND {col} <= {lit(hi.strip())}, false)"


def rules_sql(rules) -> str:
    groups: dict[str, list[str]] = {}
    for r in map(as_rule, rules):
        groups.setdefault(r.name, []).append(rule_sql(r))
    return " AND ".join("(" + " OR ".join(g) + ")" for g in groups.values()) or "true"


def _growth(parity: bool, days: int = 7) -> str:
    start = _ts(days)
    pre = _d(days + 1)
    if parity:
        return f"""
WITH m AS (
  SELECT CAST(ts AS DATE) AS d, count(event_id) AS regCount,
         CAST(max(event_id) AS BIGINT) AS memberCount
  FROM events WHERE event_type = 'signup' AND ts >= {start} GROUP BY 1),
o AS (
  SELECT CAST(ts AS DATE) AS d, CAST(max(event_id) AS BIGINT) AS orderCount,
         sum(CAST(value AS DECIMAL(18,2))) AS g
  FROM events WHERE event_type = 'purchase' AND ts >= {start} GROUP BY 1),
pre AS (
  SELECT coalesce(sum(CAST(value AS DECIMAL(18,2))), 0) AS p
  FROM events WHERE event_type = 'purchase' AND ts < {start})
SELECT strftime(m.d, '%Y-%m-%d') AS day, m.regCount, m.memberCount, o.orderCount,
       CAST(CAST(pre.p + sum(o.g) OVER (ORDER BY m.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS DOUBLE) AS gmv
FROM m JOIN o ON m.d = o.d CROSS JOIN pre"""
    return f"""
WITH m AS (
  SELECT CASE WHEN ts >= {start} THEN CAST(ts AS DATE) ELSE {pre} END AS d,
         count(event_id) AS n
  FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY 1),
mc AS (
  SELECT d, n AS regCount,
         CAST(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS memberCount
  FROM m),
o AS (
  SELECT CASE WHEN ts >= {start} THEN CAST(ts AS DATE) ELSE {pre} END AS d,
         count(event_id) AS n, sum(CAST(value AS DECIMAL(18,2))) AS g
  FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL GROUP BY 1),
oc AS (
  SELECT d,
         CAST(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS orderCount,
         CAST(sum(g) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS gmv
  FROM o)
SELECT strftime(mc.d, '%Y-%m-%d') AS day, mc.regCount, mc.memberCount, oc.orderCount,
       CAST(oc.gmv AS DOUBLE) AS gmv
FROM mc JOIN oc ON mc.d = oc.d
WHERE mc.d >= CAST({start} AS DATE)"""


def _daily(event_type: str, name: str) -> str:
    return f"""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(event_id) AS {name}
FROM events
WHERE event_type = '{event_type}' AND ts >= {_ts(14)} AND ts < {_ts(0)}
GROUP BY 1"""


def _wow(event_type: str) -> str:
    return f"""
WITH spine AS (
  SELECT CAST({_d(7)} + INTERVAL (i) DAY AS DATE) AS d FROM range(7) t(i)),
c AS (
  SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events
  WHERE event_type = '{event_type}' AND ts >= {_ts(14)} AND ts < {_ts(0)}
    AND event_id IS NOT NULL
  GROUP BY 1)
SELECT strftime(s.d, '%Y-%m-%d') AS day,
       CAST(coalesce(cur.n, 0) AS BIGINT) AS count,
       strftime(CAST(s.d - INTERVAL 7 DAY AS DATE), '%Y-%m-%d') AS prevDay,
       CAST(coalesce(prev.n, 0) AS BIGINT) AS prevCount,
       CASE WHEN coalesce(prev.n, 0) > 0
            THEN (coalesce(cur.n, 0) - prev.n) / prev.n END AS growth
FROM spine s
LEFT JOIN c cur ON cur.d = s.d
LEFT JOIN c prev ON prev.d = CAST(s.d - INTERVAL 7 DAY AS DATE)"""


def _buckets(source: str, day_expr: str, ks, sign: int = 1) -> str:
    """``sign`` 1: expired k days ago; -1: expires in k days."""
    ks_sql = ", ".join(f"({k})" for k in ks)
    return f"""
WITH {COUPON_MEMBER},
src AS ({source}),
b AS (SELECT CAST(date_diff('day', CAST({day_expr} AS DATE), {_d(0)}) - 8 AS INTEGER) * {sign} AS k, m FROM src)
SELECT ks.k, strftime(CAST({_d(0)} - INTERVAL (ks.k * {sign} + 8) DAY AS DATE), '%Y-%m-%d') AS day,
       ks.k * {sign} AS days_from_expiry, CAST(count(DISTINCT b.m) AS BIGINT) AS members
FROM (VALUES {ks_sql}) ks(k) LEFT JOIN b ON b.k = ks.k
GROUP BY ks.k"""


def _facets(rules=None) -> str:
    parts = []
    for r in rules or C.tag_rules():
        esc = [x.replace("'", "''") for x in (r.label, r.name, r.value, r.type)]
        parts.append(f"SELECT '{esc[0]}' AS label, '{esc[1]}' AS name, '{esc[2]}' AS value, "
                     f"'{esc[3]}' AS type, CAST(count_if({rule_sql(r)}) AS BIGINT) AS members FROM tags")
    return _tag_ctes() + "\n" + "\nUNION ALL\n".join(parts)


def _rule_table() -> str:
    seg = ", ".join(f"'{s}'" for s in C.SEGMENTS)
    n = len(C.SEGMENTS)
    return f"""
rule_table AS (
  WITH p AS (SELECT p_partkey AS k FROM part),
  s AS (SELECT s_suppkey AS k, s_nationkey AS nation FROM supplier),
  r AS (SELECT CAST(r_regionkey AS BIGINT) AS k FROM region)
  SELECT k AS audienceId, 'favGoods' AS name, CAST(k AS VARCHAR) AS value, 'match' AS type FROM p
  UNION ALL SELECT k, 'favGoods', CAST(k + 1 AS VARCHAR), 'match' FROM p WHERE k % 5 = 0
  UNION ALL SELECT k, 'sex', [{seg}][k % {n} + 1], 'match' FROM p WHERE k % 4 = 0
  UNION ALL SELECT k, 'sex', [{seg}][(k + 2) % {n} + 1], 'match' FROM p WHERE k % 4 = 0
  UNION ALL SELECT k, 'orderCount', CAST(6 + k % 8 AS VARCHAR), 'rangeGte' FROM p WHERE k % 4 = 1
  UNION ALL SELECT k, 'orderMoney', (1000000 + 200000 * (k % 7)) || '-' || (2600000 + 300000 * (k % 5)), 'rangeBoth'
    FROM p WHERE k % 4 = 2
  UNION ALL SELECT k, 'orderTime', '2001-0' || (1 + k % 7) || '-01', 'rangeGte' FROM p WHERE k % 4 = 3
  UNION ALL SELECT k, 'subOpenId', 'null', 'notMatch' FROM p WHERE k % 3 = 0
  UNION ALL SELECT -k, 'channel', CAST(nation AS VARCHAR), 'match' FROM s
  UNION ALL SELECT -k, 'chargeMoney', (16000 + 1000 * (k % 9)) || '-' || (24000 + 1500 * (k % 6)), 'rangeBoth' FROM s
  UNION ALL SELECT -k, 'regTime', '', 'exists' FROM s WHERE k % 2 = 0
  UNION ALL SELECT -k, 'couponTimes', '2024-01-1' || (k % 10), 'match' FROM s WHERE k % 3 = 0
  UNION ALL SELECT -k, 'freeCouponTime', '2024-01-05-2024-01-20', 'rangeBoth' FROM s WHERE k % 7 = 0
  UNION ALL SELECT k + 1000000000000, 'subOpenId', 'null', 'notMatch' FROM r
  UNION ALL SELECT k + 1000000000000, 'sex', [{seg}][k % {n} + 1], 'notMatch' FROM r
  UNION ALL SELECT k + 1000000000000, 'sex', [{seg}][(k + 1) % {n} + 1], 'notMatch' FROM r WHERE k = 4)"""


def _membership() -> str:
    """Every rule tried on every member."""
    lo, hi = "TRY_CAST(split_part(value, '-', 1) AS DOUBLE)", "TRY_CAST(split_part(value, '-', 2) AS DOUBLE)"
    return _tag_ctes() + "," + _rule_table() + f""",
tried AS (
  SELECT audienceId, memberId, name, coalesce(CASE
    WHEN name = 'favGoods' THEN list_contains(favGoods, CAST(value AS BIGINT))
    WHEN name = 'couponTimes' THEN list_contains(couponTimes, value)
    WHEN name = 'channel' THEN channel = CAST(value AS INTEGER)
    WHEN name = 'orderCount' THEN orderCount >= CAST(value AS BIGINT)
    WHEN name = 'orderMoney' THEN orderMoney BETWEEN {lo} AND {hi}
    WHEN name = 'chargeMoney' THEN chargeMoney BETWEEN {lo} AND {hi}
    WHEN name = 'orderTime' THEN orderTime >= value
    WHEN name = 'regTime' THEN regTime IS NOT NULL
    WHEN name = 'freeCouponTime' THEN freeCouponTime BETWEEN left(value, 10) AND right(value, 10)
    WHEN name = 'sex' AND type = 'match' THEN sex = value
    WHEN name = 'sex' THEN NOT coalesce(sex = value, false)
    WHEN name = 'subOpenId' THEN NOT coalesce(subOpenId = value, false) END, false) AS ok
  FROM rule_table, tags)
SELECT audienceId, memberId FROM (
  SELECT audienceId, memberId, name, bool_or(ok) AS ok FROM tried GROUP BY ALL)
GROUP BY audienceId, memberId HAVING bool_and(ok)"""


CHUNKS = """
WITH g AS (
  SELECT DISTINCT o.o_custkey AS memberId, l.l_partkey AS good
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_partkey IS NOT NULL),
n AS (SELECT *, (row_number() OVER (PARTITION BY memberId ORDER BY good) - 1) // 8 AS chunk FROM g)
SELECT memberId, CAST(chunk AS BIGINT) AS chunk,
       string_agg(CAST(good AS VARCHAR), ',' ORDER BY good) AS goods
FROM n GROUP BY memberId, chunk"""


def _date_patterns_sql() -> list[tuple[str, str]]:
    """Spark pattern → DuckDB strptime format, same order."""
    from memberscope.functions.calendar import DATE_PATTERNS
    conv = [("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"),
            ("mm", "%M"), ("ss", "%S")]
    out = []
    for p in DATE_PATTERNS:
        f = p
        for a, b in conv:
            f = f.replace(a, b)
        out.append((p, f))
    return out


def _one(f: str) -> str:
    """A text read in one format; formats without a year read it in 1970."""
    return f"try_strptime('1970 ' || txt, '%Y {f}')" if "%Y" not in f else f"try_strptime(txt, '{f}')"


def _parsed() -> str:
    return ", ".join(_one(f) for _, f in _date_patterns_sql())


def _styles() -> str:
    return " ".join(f"WHEN {_one(f)} IS NOT NULL THEN '{p}'" for p, f in _date_patterns_sql())


def _all_dates() -> str:
    pats = _date_patterns_sql()
    cases = " ".join(f"WHEN {i} THEN strftime(t, '{f}')" for i, (_, f) in enumerate(pats))
    return f"""
WITH texts AS (
  SELECT o_orderkey, CASE o_orderkey % {len(pats) + 1} {cases}
         ELSE '#' || CAST(o_orderkey AS VARCHAR) END AS txt
  FROM (SELECT o_orderkey, o_orderdate + INTERVAL (o_orderkey * 7919 % 86400) SECOND AS t FROM orders))"""


def _normalize() -> str:
    pats = _date_patterns_sql()
    style = " ".join(f"WHEN try_strptime(txt, '{f}') IS NOT NULL THEN '{p}'" for p, f in pats)
    parsed = ", ".join(f"try_strptime(txt, '{f}')" for _, f in pats)
    return f"""
WITH mixed AS (
  SELECT o_orderkey,
         CASE o_orderkey % 4
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M')
           WHEN 2 THEN strftime(o_orderdate, '%Y年%m月%d日')
           ELSE '#' || CAST(o_orderkey AS VARCHAR) END AS txt
  FROM orders)
SELECT o_orderkey, txt, CASE {style} END AS d_style,
       coalesce({parsed}) IS NOT NULL AS d_valid,
       strftime(coalesce({parsed}), '%Y-%m-%d %H:%M:%S') AS d_text
FROM mixed"""


WEEK_CN = "['星期一','星期二','星期三','星期四','星期五','星期六','星期日']"
WEEK_EN = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']"
WEEK_SHORT = "['Mon.','Tues.','Wed.','Thur.','Fri.','Sat.','Sun.']"


def oracle_sql() -> dict[str, str]:
    tags_ = _tag_ctes()
    free = f"SELECT member_id AS m, min(create_time) AS t FROM coupon_member " \
           f"WHERE coupon_id = {C.FREE_COUPON_ID} GROUP BY member_id"
    other = f"SELECT DISTINCT member_id AS m, CAST(create_time AS DATE) AS t FROM coupon_member " \
            f"WHERE coupon_id <> {C.FREE_COUPON_ID}"
    out = {
        "member_sex": """
SELECT c_mktsegment AS memberSex, count(c_custkey) AS sexCount
FROM customer GROUP BY c_mktsegment""",
        "member_channel": """
SELECT c_nationkey AS memberChannel, count(c_custkey) AS channelCount
FROM customer GROUP BY c_nationkey""",
        "member_subscription": f"""
WITH {MEMBER}
SELECT CAST(count_if(mp_open_id <> 'null') AS BIGINT) AS subCount,
       CAST(count_if(mp_open_id = 'null') AS BIGINT) AS unSubCount
FROM member""",
        "member_heat": f"""
WITH {COUPON_MEMBER},
rc AS (SELECT CAST(count_if({PHONE} = 'null') AS BIGINT) AS reg,
              CAST(count_if({PHONE} <> 'null') AS BIGINT) AS complete FROM customer),
oa AS (SELECT CAST(count_if(n = 1) AS BIGINT) AS "order",
              CAST(count_if(n >= 2) AS BIGINT) AS orderAgain
       FROM (SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey)),
cp AS (SELECT count(DISTINCT member_id) AS coupon FROM coupon_member)
SELECT reg, complete, "order", orderAgain, coupon FROM rc, oa, cp""",
        "conversion_funnel": f"""
WITH {COUPON_MEMBER},
done AS (SELECT o_custkey AS m, count(o_orderkey) AS n FROM orders
         WHERE o_orderstatus = 'F' GROUP BY o_custkey),
buy AS (SELECT DISTINCT member_id AS m FROM coupon_member WHERE coupon_channel = 1)
SELECT
  (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'view') AS present,
  (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'click') AS click,
  CAST(NULL AS BIGINT) AS addCart,
  (SELECT count(*) FROM done) AS "order",
  (SELECT count(*) FROM done WHERE n > 1) AS orderAgain,
  (SELECT count(*) FROM done JOIN buy ON done.m = buy.m WHERE done.n > 1) AS chargeCoupon""",
        "growth_daily": _growth(False),
        "growth_daily_parity": _growth(True),
        "reg_two_weeks": _daily("signup", "regCount"),
        "order_two_weeks": _daily("purchase", "orderCount"),
        "week_on_week": _wow("signup"),
        "week_on_week_orders": _wow("purchase"),
        "hot_words": r"""
WITH lines AS (
  SELECT unnest(string_split_regex(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r')) AS line
  FROM documents WHERE text IS NOT NULL)
SELECT word, count(*) AS count
FROM (SELECT string_split(line, ' ')[1] AS word FROM lines)
WHERE word IS NOT NULL
GROUP BY word ORDER BY count DESC, word ASC LIMIT 10""",
        "tag_member_base": f"""
WITH {MEMBER}
SELECT id AS memberId, phone, sex, member_channel AS channel, mp_open_id AS subOpenId,
       address_default_id AS address, strftime(create_time, '%Y-%m-%d') AS regTime
FROM member""",
        "tag_order_behavior": tags_ + """
SELECT memberId, orderCount, orderTime, CAST(orderMoney AS DOUBLE) AS orderMoney,
       array_to_string(list_transform(favGoods, lambda x: CAST(x AS VARCHAR)), ',') AS favGoods
FROM ob""",
        "tag_order_behavior_parity": _tag_ctes(parity=True) + """
SELECT memberId, orderCount, orderTime, CAST(orderMoney AS DOUBLE) AS orderMoney,
       array_to_string(list_transform(favGoods, lambda x: CAST(x AS VARCHAR)), ',') AS favGoods
FROM ob""",
        "tag_order_features": tags_ + """
SELECT ob.memberId, ob.orderCount, ob.orderTime, CAST(ob.orderMoney AS DOUBLE) AS orderMoney,
       array_to_string(list_transform(ob.favGoods, lambda x: CAST(x AS VARCHAR)), ',') AS favGoods,
       ot.overTime
FROM ob LEFT JOIN ot ON ob.memberId = ot.memberId""",
        "tag_free_coupon": tags_ + "\nSELECT memberId, freeCouponTime FROM fc",
        "tag_free_coupon_parity": _tag_ctes(parity=True) + "\nSELECT memberId, freeCouponTime FROM fc",
        "tag_coupon_times": tags_ + "\nSELECT memberId, array_to_string(couponTimes, ',') AS couponTimes FROM ct",
        "tag_charge_money": tags_ + "\nSELECT memberId, CAST(chargeMoney AS DOUBLE) AS chargeMoney FROM cm",
        "tag_over_time": tags_ + "\nSELECT memberId, overTime FROM ot",
        "tag_feedback_latest": tags_ + "\nSELECT memberId, feedBack FROM fb",
        "member_tags": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags",
        "member_tags_parity": _tag_ctes(parity=True) + f"\nSELECT {TAG_TEXT_COLS} FROM tags",
        "audience_select": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags WHERE {rules_sql(C.AUDIENCE_RULES)}",
        "audience_select_goods": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags WHERE {rules_sql(C.AUDIENCE_GOODS_RULES)}",
        "tag_facets": _facets(),
        "audience_index_select": tags_ + f"\nSELECT memberId FROM tags WHERE {rules_sql(C.AUDIENCE_RULES)}",
        "audience_index_goods": tags_ + f"\nSELECT memberId FROM tags WHERE {rules_sql(C.AUDIENCE_INDEX_RULES)}",
        "tag_index_facets": _facets(C.fitted_rules()),
        "audience_membership": _membership(),
        "goods_chunks": CHUNKS,
        "audience_goods_chunks": tags_ + """
SELECT memberId FROM tags
WHERE len(list_filter(favGoods, lambda x: x IN (1, 2) OR x BETWEEN 10 AND 12)) > 0""",
        "growth_daily_ledger": _growth(False, 20),
        "member_tags_bucketed": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags",
        "tag_index_documents": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags WHERE memberId IS NOT NULL",
        "tag_charge_money_isolated": tags_ + "\nSELECT memberId, CAST(chargeMoney AS DOUBLE) AS chargeMoney FROM cm",
        "active_members_range": """
WITH r AS (
  SELECT s_suppkey AS rangeId, CAST(DATE '2023-12-28' + INTERVAL (s_suppkey % 31) DAY AS DATE) AS a,
         CAST(DATE '2023-12-28' + INTERVAL (s_suppkey % 31 + s_suppkey % 23) DAY AS DATE) AS b FROM supplier)
SELECT rangeId, strftime(a, '%Y-%m-%d') AS start, strftime(b, '%Y-%m-%d') AS "end",
       count(DISTINCT user_id) AS members
FROM r LEFT JOIN events ON ts >= a AND ts < b
GROUP BY rangeId, a, b""",
        "normalize_all_dates": _all_dates() + f"""
SELECT o_orderkey, txt, CASE {_styles()} END AS d_style, coalesce({_parsed()}) IS NOT NULL AS d_valid,
       strftime(coalesce({_parsed()}), '%Y/%m/%d %H:%M:%S') AS d_text
FROM texts""",
        "shift_date_texts": _all_dates() + """
SELECT o_orderkey, """ + ", ".join(
            f"""CASE {' '.join(f"WHEN {_one(f)} IS NOT NULL THEN strftime({_one(f)} + INTERVAL ({n}) {unit}, '{f}')"
                 for _, f in _date_patterns_sql())} END AS {unit.lower()}"""
            for unit, n in C.TEXT_SHIFTS) + "\nFROM texts",
        "member_tags_incremental": tags_ + f"\nSELECT {TAG_TEXT_COLS} FROM tags",
        "free_coupon_reminder": _buckets(free, "t", range(1, 8)),
        "free_coupon_expiring": _buckets(free, "t", range(1, 8), -1),
        "coupon_expiry": _buckets(other, "t", (1, 3, 5, 7)),
        "coupon_expiring": _buckets(other, "t", (1, 3, 5, 7), -1),
        "normalize_dates": _normalize(),
        "calendar_features": f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, CAST(hour(o_orderdate) AS INTEGER) AS hour,
       CAST(minute(o_orderdate) AS INTEGER) AS minute,
       CAST(second(o_orderdate) AS INTEGER) AS second, strftime(o_orderdate, '%Y-%m-%d') AS date,
       strftime(o_orderdate, '%H:%M:%S') AS time, CAST(isodow(o_orderdate) AS INTEGER) AS weekday,
       {WEEK_CN}[isodow(o_orderdate)] AS weekday_cn,
       {WEEK_EN}[isodow(o_orderdate)] AS weekday_en,
       {WEEK_SHORT}[isodow(o_orderdate)] AS weekday_short
FROM orders""",
        "shift_dates": """
SELECT o_orderkey,
       strftime(o_orderdate + INTERVAL 1 YEAR + INTERVAL 1 MONTH + INTERVAL 3 DAY + INTERVAL 5 HOUR,
                '%Y-%m-%d %H:%M:%S') AS shifted
FROM orders""",
        "interval_days": """
SELECT o_custkey AS memberId,
       CAST(abs(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE))) AS INTEGER) AS days
FROM orders GROUP BY o_custkey""",
    }
    out["member_overview_json"] = f"""
WITH {MEMBER}, {COUPON_MEMBER},
sx AS (SELECT list(struct_pack(memberSex := sex, sexCount := n) ORDER BY sex, n) AS l
       FROM (SELECT sex, count(id) AS n FROM member GROUP BY sex)),
ch AS (SELECT list(struct_pack(memberChannel := member_channel, channelCount := n)
                   ORDER BY member_channel, n) AS l
       FROM (SELECT member_channel, count(id) AS n FROM member GROUP BY member_channel)),
sb AS (SELECT [struct_pack(subCount := count_if(mp_open_id <> 'null'),
                           unSubCount := count_if(mp_open_id = 'null'))] AS l FROM member),
rc AS (SELECT count_if(phone = 'null') AS reg, count_if(phone <> 'null') AS complete FROM member),
oa AS (SELECT count_if(n = 1) AS o1, count_if(n >= 2) AS o2
       FROM (SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey)),
cp AS (SELECT count(DISTINCT member_id) AS c FROM coupon_member)
SELECT CAST(to_json(struct_pack(
         memberSexes := sx.l, memberChannels := ch.l, memberMpSubs := sb.l,
         memberHeat := struct_pack(reg := rc.reg, complete := rc.complete, "order" := oa.o1,
                                   orderAgain := oa.o2, coupon := cp.c))) AS VARCHAR) AS value
FROM sx, ch, sb, rc, oa, cp"""
    out["conversion_funnel_constants"] = f"""
WITH {COUPON_MEMBER},
done AS (SELECT o_custkey AS m, count(o_orderkey) AS n FROM orders
         WHERE o_orderstatus = 'F' GROUP BY o_custkey),
buy AS (SELECT DISTINCT member_id AS m FROM coupon_member WHERE coupon_channel = 1)
SELECT CAST(1000 AS BIGINT) AS present, CAST(800 AS BIGINT) AS click,
       CAST(600 AS BIGINT) AS addCart,
       (SELECT count(*) FROM done) AS "order",
       (SELECT count(*) FROM done WHERE n > 1) AS orderAgain,
       (SELECT count(*) FROM done JOIN buy ON done.m = buy.m WHERE done.n > 1) AS chargeCoupon"""
    out["tag_over_time_per_delivery"] = """
WITH per_order AS (
  SELECT o.o_custkey AS memberId, o.o_orderdate AS pick, max(l.l_shipdate) AS arrive
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate)
SELECT memberId,
       max(CAST(floor(epoch(arrive)) AS BIGINT) - CAST(floor(epoch(pick)) AS BIGINT)) AS overTime
FROM per_order GROUP BY memberId"""
    out["growth_rollup"] = """
WITH m AS (
  SELECT CAST(ts AS DATE) AS d, count(*) AS reg_rows, count(event_id) AS regCount
  FROM events WHERE event_type = 'signup' AND ts IS NOT NULL GROUP BY 1),
o AS (
  SELECT CAST(ts AS DATE) AS d, count(*) AS order_rows, count(event_id) AS orders,
         sum(CAST(value AS DECIMAL(18,2))) AS gmv_day
  FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL GROUP BY 1)
SELECT coalesce(m.d, o.d) AS d,
       CAST(coalesce(m.reg_rows, 0) AS BIGINT) AS reg_rows,
       CAST(coalesce(m.regCount, 0) AS BIGINT) AS regCount,
       CAST(coalesce(o.order_rows, 0) AS BIGINT) AS order_rows,
       CAST(coalesce(o.orders, 0) AS BIGINT) AS orders,
       CAST(o.gmv_day AS DOUBLE) AS gmv_day
FROM m FULL JOIN o ON m.d = o.d"""
    out["free_coupon_reminder_stored"] = out["free_coupon_reminder"]
    out["audience_text_export"] = out["audience_index_goods"]
    out["hot_words_files"] = out["hot_words"]
    out["member_sex_sql"] = out["member_sex"]
    out["reg_two_weeks_sql"] = out["reg_two_weeks"]
    out["member_heat_orders_sql"] = """
SELECT CAST(count_if(n = 1) AS BIGINT) AS "order", CAST(count_if(n >= 2) AS BIGINT) AS orderAgain
FROM (SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey)"""
    return out
