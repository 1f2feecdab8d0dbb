"""The logical star schema as DuckDB SQL (oracle side of ``retentio.sources.adapter``).

Same fixed values as the Spark adapter, written independently as CTEs.
``sql(body, *views)`` prepends the named views (and what they depend on).
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "countries": ((), """
        SELECT n_nationkey AS country_id, n_name AS country_name, n_regionkey AS currency_id,
               'N' || CAST(n_nationkey AS VARCHAR) AS iso_code,
               CASE n_regionkey WHEN 0 THEN 'America/Argentina/Buenos_Aires' WHEN 1 THEN 'America/Montevideo'
                    WHEN 2 THEN 'America/Santiago' WHEN 3 THEN 'America/Bogota' WHEN 4 THEN 'America/Panama'
                    ELSE 'UTC' END AS timezone,
               TRUE AS active
        FROM nation"""),
    "fx_rates": ((), """
        SELECT r_regionkey AS currency_id, CAST(m AS DATE) AS currency_exchange_date,
               CASE WHEN r_regionkey = 3 AND CAST(m AS DATE) = DATE '2001-05-01' THEN 0.0
                    ELSE CAST(1000037 + r_regionkey * 500000 + month(m) * 10000 AS DOUBLE) / 1000000.0 END AS rate_us,
               CASE WHEN r_regionkey = 3 AND CAST(m AS DATE) = DATE '2001-05-01' THEN 0.0
                    ELSE CAST(1000037 + r_regionkey * 500000 + month(m) * 10000 AS DOUBLE) / 1000000.0 * 0.9 END AS rate_eu
        FROM region, (SELECT unnest(generate_series(date_trunc('month', MIN(o_orderdate)), date_trunc('month', MAX(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)
        WHERE NOT (r_regionkey = 4 AND CAST(m AS DATE) = DATE '2001-06-01')"""),
    "users": ((), """
        SELECT c_custkey AS user_id, c_nationkey AS country_id, c_mktsegment AS city_name,
               'AREA_' || CAST(CAST(floor(c_acctbal / 1000) AS INTEGER) AS VARCHAR) AS area_name
        FROM customer"""),
    "user_cities": (("countries",), """
        SELECT c.c_custkey AS user_id, cn.country_name AS country, c.c_mktsegment AS city,
               CASE WHEN c.c_acctbal >= 0 THEN 'ORDERS' ELSE 'ADDRESS' END AS based
        FROM customer c LEFT JOIN countries cn ON cn.country_id = c.c_nationkey"""),
    "population": ((), "SELECT c_custkey AS user_id FROM customer WHERE c_acctbal < 1000"),
    "legacy_orders": ((), """
        SELECT CAST(ts AS DATE) AS order_date, user_id, COUNT(*) AS qty_orders, 'CONFIRMED' AS order_status
        FROM events WHERE event_type = 'purchase' GROUP BY 1, 2"""),
    "legacy_segments": ((), """
        SELECT user_id, CASE WHEN COUNT(CASE WHEN event_type = 'view' THEN 1 END) > COUNT(CASE WHEN event_type = 'click' THEN 1 END)
                             THEN 'LOYAL_BROWSER' ELSE 'CASUAL' END AS segment
        FROM events GROUP BY 1"""),
    "partners": ((), """
        SELECT s_suppkey AS partner_id,
               CASE WHEN s_acctbal >= 4300 THEN 'TOTAL_AMOUNT' ELSE 'COMMISSION' END AS payment_mode,
               s_nationkey AS country_id,
               CASE WHEN s_acctbal < 0 THEN 'Shop' WHEN s_acctbal < 2000 THEN 'Drinks' WHEN s_acctbal < 4000 THEN 'Pharmacy'
                    WHEN s_acctbal < 7000 THEN 'Groceries' ELSE 'Restaurant' END AS business_type_name
        FROM supplier"""),
    "partners_monthly": (("orders_f",), """
        WITH pm AS (SELECT restaurant_id, CAST(date_trunc('month', registered_date) AS DATE) AS month,
                           MAX(CASE WHEN order_status = 'CONFIRMED' THEN 1 ELSE 0 END) AS conf
                    FROM orders_f WHERE restaurant_id IS NOT NULL GROUP BY 1, 2)
        SELECT coalesce(a.restaurant_id, b.restaurant_id) AS restaurant_id,
               CAST(coalesce(a.month, b.month) AS TIMESTAMP) AS full_date,
               a.conf IS NOT NULL AS is_online,
               a.conf IS NULL AND b.restaurant_id IS NOT NULL AS is_churned,
               coalesce(a.conf = 1, FALSE) AS has_confirmed_orders
        FROM pm a FULL JOIN (SELECT restaurant_id, CAST(month + INTERVAL 1 MONTH AS DATE) AS month FROM pm) b
          ON a.restaurant_id = b.restaurant_id AND a.month = b.month"""),
    "campaigns": ((), """
        SELECT p_partkey AS campaign_id,
               upper(p_type) || '_' || upper(replace(p_brand, '#', '')) || '_' || upper(replace(p_name, ' ', '_')) AS campaign_name,
               p_size AS campaign_size
        FROM part"""),
    "orders_f": (("users", "countries", "first_lines", "partners"), """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id,
               CASE WHEN o.o_orderstatus = 'P' THEN 'REJECTED' ELSE 'CONFIRMED' END AS order_status,
               CAST(o.o_orderdate AS DATE) AS registered_date, o.o_orderdate AS registered_at,
               CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS business_type_id,
               CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'Restaurant' WHEN '2' THEN 'Groceries'
                    WHEN '3' THEN 'Pharmacy' WHEN '4' THEN 'Drinks' ELSE 'Shop' END AS business_type_name,
               CASE WHEN o.o_orderstatus <> 'P' AND o.o_orderkey = first_value(o.o_orderkey) OVER (
                        PARTITION BY o.o_custkey ORDER BY (o.o_orderstatus = 'P'), o.o_orderdate, o.o_orderkey)
                    THEN 1 ELSE 0 END AS is_acquisition,
               o.o_totalprice >= 250000 AS with_logistics,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount_no_discount,
               CASE WHEN o.o_totalprice >= 250000 AND substr(o.o_orderpriority, 1, 1) <> '1'
                    THEN CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 ELSE 0 END AS shipping_amount_no_discount,
               CASE WHEN o.o_totalprice >= 250000 AND substr(o.o_orderpriority, 1, 1) <> '1'
                    THEN CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.02 ELSE 0 END AS shipping_amount,
               CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.15 AS commission_amount,
               u.country_id, u.city_name, u.area_name, cn.country_name, cn.currency_id,
               fl.l_suppkey AS restaurant_id, p.payment_mode,
               CASE WHEN fl.l_discount >= 0.05 THEN CAST(fl.l_extendedprice AS DECIMAL(18,2)) * CAST(fl.l_discount AS DECIMAL(4,2))
                    ELSE 0 END AS voucher_discount_amount,
               CASE WHEN fl.l_discount >= 0.05 THEN 1 ELSE 0 END AS has_voucher_discount,
               CASE WHEN fl.l_returnflag = 'N' THEN 1 ELSE 0 END AS has_joker_discount,
               CASE WHEN fl.l_linestatus = 'F' THEN CAST(fl.l_extendedprice AS DECIMAL(18,2)) * CAST(fl.l_discount AS DECIMAL(4,2))
                    ELSE 0 END AS discount_paid_by_company,
               CASE WHEN o.o_orderstatus = 'P' THEN
                    CASE WHEN fl.l_returnflag = 'A' AND fl.l_linestatus = 'F' THEN 'Platform'
                         WHEN fl.l_returnflag = 'A' THEN 'Restaurant'
                         WHEN fl.l_returnflag = 'R' THEN 'User'
                         WHEN fl.l_returnflag = 'N' THEN 'Rider' END END AS fail_rate_owner
        FROM orders o
        JOIN users u ON u.user_id = o.o_custkey
        LEFT JOIN countries cn ON cn.country_id = u.country_id
        LEFT JOIN first_lines fl ON fl.order_id = o.o_orderkey
        LEFT JOIN partners p ON p.partner_id = fl.l_suppkey"""),
    "first_lines": ((), """
        SELECT order_id, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
               l_returnflag, l_linestatus, l_shipdate
        FROM (SELECT l_orderkey AS order_id, *,
                     row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
              FROM lineitem) x
        WHERE rn = 1"""),
    "order_partner": (("first_lines", "partners"), """
        SELECT fl.order_id, fl.l_suppkey AS restaurant_id, p.payment_mode
        FROM first_lines fl LEFT JOIN partners p ON p.partner_id = fl.l_suppkey"""),
    "discounts": ((), """
        SELECT l_orderkey AS order_id,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS discount_type_id,
               CASE l_returnflag WHEN 'A' THEN 'VOUCHER' WHEN 'R' THEN 'FREE_DELIVERY' ELSE 'JOKER' END AS discount_type_name,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS discount_amount,
               CASE WHEN l_linestatus = 'F' THEN 'COMPANY' ELSE 'PARTNER' END AS discount_paid_by
        FROM lineitem"""),
    "creations": (("users", "campaigns", "partners"), """
        SELECT concat('CP', o.o_orderkey, '-', l.l_linenumber, '-', l.l_partkey, '-', l.l_suppkey) AS coupon_id, concat('C', l.l_partkey) AS code,
               o.o_orderkey AS issue_order_id, u.user_id, u.country_id AS coupon_country_id, u.city_name, u.area_name,
               l.l_partkey AS campaign_id, ca.campaign_name,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS amount,
               IF(l.l_quantity > 25, CAST(l.l_quantity AS INTEGER), 1) AS usage_limit,
               CAST(CAST(o.o_orderdate AS DATE) - CAST(ca.campaign_size AS INTEGER) AS TIMESTAMP) AS created_at, created_at AS starts_at,
               IF(l.l_returnflag = 'N', NULL, created_at + INTERVAL 30 DAY) AS expires_at,
               ca.campaign_size % 10 IS DISTINCT FROM 0 AS valid,
               IF(l.l_linestatus = 'F', 'PERCENTAGE', 'AMOUNT') AS discount_type,
               CAST(round(l.l_discount * 100, 0) AS INTEGER) AS discount_value,
               IF(ca.campaign_size > 25, 500, 250) AS max_amount, IF(l.l_quantity > 25, 200, 100) AS min_amount, p.payment_mode,
               l.l_quantity AS quantity, CAST(l.l_tax AS DECIMAL(4,2)) AS tax
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN users u ON u.user_id = o.o_custkey
        LEFT JOIN campaigns ca ON ca.campaign_id = l.l_partkey LEFT JOIN partners p ON p.partner_id = l.l_suppkey
        WHERE l.l_discount >= 0.05"""),
    "trades": (("creations",), """
        SELECT e.coupon_id, e.code, e.order_id, e.type, CAST(o.o_orderdate AS TIMESTAMP) + e.delay AS traded_at, e.amount AS amount_used
        FROM (SELECT *, issue_order_id AS order_id, 'CONSUME' AS type, INTERVAL 0 MINUTE AS delay FROM creations
              UNION ALL SELECT *, issue_order_id, 'RESERVE', INTERVAL 0 MINUTE FROM creations WHERE tax >= 0.07
              UNION ALL SELECT *, issue_order_id, 'CONSUME', INTERVAL 1 MINUTE FROM creations WHERE tax >= 0.08
              UNION ALL SELECT *, issue_order_id + 1, 'CONSUME', INTERVAL 0 MINUTE FROM creations WHERE quantity > 45) e
        JOIN orders o ON o.o_orderkey = e.order_id
        JOIN users u ON u.user_id = o.o_custkey
        WHERE e.quantity > 5 AND CAST(o.o_orderdate AS DATE) >= CAST(e.created_at AS DATE)"""),
    "coupons": (("creations", "trades"), """
        SELECT c.coupon_id, k.order_id, c.user_id, c.coupon_country_id, c.city_name, c.area_name, c.campaign_id, c.campaign_name,
               k.amount_used AS used_amount, c.usage_limit, c.created_at, c.starts_at, c.expires_at, c.discount_type, c.discount_value,
               c.max_amount, c.min_amount, c.payment_mode, k.day AS order_registered_date
        FROM creations c LEFT JOIN (
          SELECT coupon_id, order_id, amount_used, CAST(traded_at AS DATE) AS day FROM trades WHERE type = 'CONSUME' GROUP BY ALL) k
          ON k.coupon_id = c.coupon_id"""),
    "wallet": ((), """
        SELECT l.l_orderkey AS order_id, 'Purchase' AS operation, 'W_' || upper(p.p_type) AS campaign_code,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS amount
        FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
        WHERE l.l_returnflag = 'R'"""),
    "funding": ((), """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_returnflag = 'A' THEN 10 WHEN l_linestatus = 'F' THEN 25 ELSE 35 END AS type,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS amount
        FROM lineitem WHERE l_returnflag IN ('R', 'A')"""),
    "vouchers_daily": (("coupons", "orders_f", "countries"), """
        SELECT c.order_registered_date AS date, cn.country_name, c.campaign_name, c.discount_type AS coupon_type,
               CASE WHEN c.payment_mode = 'TOTAL_AMOUNT' THEN 1 ELSE 0 END AS payment_shopper,
               COUNT(*) AS coupons_redeemed_confirmed,
               CAST(SUM(o.is_acquisition) AS BIGINT) AS coupon_orders_acq_confirmed,
               SUM(c.used_amount) AS coupon_used_amount_confirmed
        FROM coupons c JOIN orders_f o ON o.order_id = c.order_id
        LEFT JOIN countries cn ON cn.country_id = c.coupon_country_id
        WHERE o.order_status = 'CONFIRMED'
        GROUP BY 1, 2, 3, 4, 5"""),
}


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def sql(body: str, *views: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <views>, <extra> <body>``; ``extra`` are query-local CTEs, in order."""
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in _order(views)]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
