"""Table loading and the domain views over the shared tables.

The products speak the member-analytics vocabulary (member, order, order line,
coupon holding, coupon, delivery, feedback). The shared test tables are a
TPC-H-like star schema plus an event stream, so each domain view below is a
projection (sometimes a join or a filter) of those tables. Every view is lazy:
Catalyst prunes the columns a product does not use and pushes its filters into
the Parquet scan.

Domain view        built from
-----------------  ------------------------------------------------------------
member             customer: id=c_custkey, sex=c_mktsegment,
                   phone='null' (registered only) when c_acctbal >= 9000,
                   else c_name,
                   member_channel=c_nationkey, address_default_id=c_nationkey,
                   mp_open_id='null' (not subscribed) when c_acctbal < 0,
                   else c_name
registration       events where event_type='signup': id=event_id, create_time=ts
order              orders: order_id, member_id, order_status (F done, O open,
                   P third code), pay_price=origin_price=o_totalprice,
                   create_time=o_orderdate
purchase           events where event_type='purchase': order_id=event_id,
                   origin_price=value, create_time=ts (growth and weeks)
order item         lineitem: order_id=l_orderkey, commodity_id=l_partkey
order line         the same with arrive_time=l_shipdate (deliveries are the
                   lines, so order and delivery tags can share one pass)
coupon holding     events: member_id=user_id, coupon_id=props.k,
                   coupon_channel=1 for purchase events else 2, create_time=ts
coupon             part: id=p_partkey, coupon_price=p_retailprice
delivery           lineitem joined to orders, one row per order:
                   member_id=o_custkey, pick_time=o_orderdate,
                   arrive_time=last l_shipdate
feedback           events where event_type='error': id=event_id,
                   member_id=user_id, feedback_type=props.k % 4 + 1
search lines       documents.text split into lines
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, source: str, name: str,
               kind: str = "folder") -> DataFrame:
    """One table: ``<source>/<name>.parquet`` for ``kind="folder"``, or
    ``<source>.<name>`` of the catalog (metastore) for ``kind="catalog"``.

    Files are listed on every call, so a long-lived session sees appended
    files; ``Tables`` keeps what it has loaded for the length of one query."""
    if kind == "folder":
        return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")
    if kind == "catalog":
        return spark.table(f"{source}.{name}")
    raise ValueError(f"kind must be 'folder' or 'catalog', not {kind!r}")


class Tables:
    """Lazy accessor for the shared tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


class LoadedTables:
    """The shared tables as given frames."""

    def __init__(self, **frames: DataFrame):
        self.__dict__.update(frames)


def _prop_k():
    return F.get_json_object("props", "$.k").cast("int")


# ---------------------------------------------------------------- members

def members(customer: DataFrame) -> DataFrame:
    """t_member without the registration time (see ``member_reg_times``)."""
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_acctbal") >= 9000, F.lit("null"))
         .otherwise(F.col("c_name")).alias("phone"),
        F.col("c_mktsegment").alias("sex"),
        F.col("c_nationkey").alias("member_channel"),
        F.when(F.col("c_acctbal") < 0, F.lit("null"))
         .otherwise(F.col("c_name")).alias("mp_open_id"),
        F.col("c_nationkey").alias("address_default_id"),
    )


def registrations(events: DataFrame) -> DataFrame:
    """Registration records: one row per signup event."""
    return (events.where(F.col("event_type") == "signup")
            .select(F.col("event_id").alias("id"),
                    F.col("user_id").alias("member_id"),
                    F.col("ts").alias("create_time")))


def member_reg_times(events: DataFrame) -> DataFrame:
    """First registration time per member (one row per member)."""
    return (registrations(events).groupBy("member_id")
            .agg(F.min("create_time").alias("create_time")))


def members_with_reg_time(customer: DataFrame, events: DataFrame) -> DataFrame:
    """Full t_member: members left-joined to their first signup."""
    reg = member_reg_times(events).withColumnRenamed("member_id", "id")
    return members(customer).join(reg, "id", "left")


# ---------------------------------------------------------------- orders

def orders(orders_tbl: DataFrame) -> DataFrame:
    return orders_tbl.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("member_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("origin_price"),
        F.col("o_totalprice").alias("pay_price"),
        F.col("o_orderdate").alias("create_time"),
    )


def purchases(events: DataFrame) -> DataFrame:
    """Orders as purchase events (the growth and week products use these)."""
    return (events.where(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("order_id"),
                    F.col("user_id").alias("member_id"),
                    F.col("value").alias("origin_price"),
                    F.col("ts").alias("create_time")))


def order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.col("l_orderkey").alias("order_id"),
                           F.col("l_partkey").alias("commodity_id"))


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines with their arrival (the delivery of the line)."""
    return lineitem.select(F.col("l_orderkey").alias("order_id"),
                           F.col("l_partkey").alias("commodity_id"),
                           F.col("l_shipdate").alias("arrive_time"))


# ---------------------------------------------------------------- coupons

def coupon_members(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("member_id"),
        _prop_k().alias("coupon_id"),
        F.when(F.col("event_type") == "purchase", F.lit(1))
         .otherwise(F.lit(2)).alias("coupon_channel"),
        F.col("ts").alias("create_time"),
    )


def coupons(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"),
                       F.col("p_retailprice").alias("coupon_price"))


# ---------------------------------------------------------------- service

def deliveries(lineitem: DataFrame, orders_tbl: DataFrame) -> DataFrame:
    """One delivery per order: pick = order day, arrive = last ship day.

    Lines are reduced to one row per order *before* the join (partial and
    final aggregation on the order key), so the join sees one row per order
    on each side however many lines an order has. Both tag formulas built on
    deliveries (max minus max, and max of differences) are unchanged by this,
    because every line of an order shares its pick time.
    """
    arrive = (lineitem.groupBy(F.col("l_orderkey").alias("order_id"))
              .agg(F.max("l_shipdate").alias("arrive_time")))
    picks = orders_tbl.select(F.col("o_orderkey").alias("order_id"),
                              F.col("o_custkey").alias("member_id"),
                              F.col("o_orderdate").alias("pick_time"))
    return picks.join(arrive, "order_id", "inner").select(
        "member_id", "pick_time", "arrive_time")


def feedback(events: DataFrame) -> DataFrame:
    return (events.where(F.col("event_type") == "error")
            .select(F.col("event_id").alias("id"),
                    F.col("user_id").alias("member_id"),
                    (F.pmod(_prop_k(), F.lit(4)) + 1).alias("feedback_type")))


class Domain:
    """All domain views of one data folder, built lazily."""

    #: The status of a completed order.
    done_status = "F"

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, tables=None):
        """Over the tables of a folder, or over ``tables`` with the shared
        tables as attributes."""
        self.t = tables if tables is not None else Tables(spark, sf_dir)

    @property
    def member(self) -> DataFrame:
        return members_with_reg_time(self.t.customer, self.t.events)

    @property
    def growth_sources(self) -> dict[str, tuple[DataFrame, str]]:
        """File tables behind registrations and purchases, with their time."""
        return {"events": (self.t.events, "ts")}

    @property
    def member_plain(self) -> DataFrame:
        return members(self.t.customer)

    @property
    def behaviour(self) -> DataFrame:
        return self.t.events

    @property
    def registration(self) -> DataFrame:
        return registrations(self.t.events)

    @property
    def order(self) -> DataFrame:
        return orders(self.t.orders)

    @property
    def purchase(self) -> DataFrame:
        return purchases(self.t.events)

    @property
    def order_item(self) -> DataFrame:
        return order_items(self.t.lineitem)

    @property
    def order_line(self) -> DataFrame:
        return order_lines(self.t.lineitem)

    @property
    def coupon_member(self) -> DataFrame:
        return coupon_members(self.t.events)

    @property
    def coupon_bought(self) -> DataFrame:
        """Holdings of channel 1, filtered on the stored column so that the
        filter reaches the scan."""
        return coupon_members(self.t.events.where(F.col("event_type") == "purchase"))

    @property
    def coupon_granted(self) -> DataFrame:
        """Holdings of every other channel."""
        return coupon_members(self.t.events.where(
            (F.col("event_type") != "purchase") | F.col("event_type").isNull()))

    @property
    def coupon(self) -> DataFrame:
        return coupons(self.t.part)

    @property
    def delivery(self) -> DataFrame:
        return deliveries(self.t.lineitem, self.t.orders)

    @property
    def feedback(self) -> DataFrame:
        return feedback(self.t.events)


class MemberTables:
    """The same views over member-analytics tables that exist under their own
    names (``t_member``, ``t_order``, ``t_order_commodity``,
    ``t_coupon_member``, ``t_coupon``, ``t_delivery``, ``t_feedback``): tables
    of a catalog database, or ``<folder>/<name>.parquet``.

    Growth and weeks read members and orders; there is no behaviour table, and
    deliveries are a table of their own (no order lines with arrivals)."""

    done_status = 2
    behaviour = None
    order_line = None

    def __init__(self, spark: SparkSession, source: str, kind: str = "catalog"):
        self.spark, self.source, self.kind = spark, source, kind
        self._cache: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.source, name, self.kind)
        return self._cache[name]

    @property
    def member(self) -> DataFrame:
        return self._table("t_member")

    member_plain = registration = member

    @property
    def growth_sources(self) -> dict[str, tuple[DataFrame, str]]:
        return {"t_member": (self.member, "create_time"), "t_order": (self.order, "create_time")}

    @property
    def order(self) -> DataFrame:
        return self._table("t_order")

    purchase = order

    @property
    def order_item(self) -> DataFrame:
        return self._table("t_order_commodity")

    @property
    def coupon_member(self) -> DataFrame:
        return self._table("t_coupon_member")

    @property
    def coupon_bought(self) -> DataFrame:
        return self.coupon_member.where("coupon_channel = 1")

    @property
    def coupon(self) -> DataFrame:
        return self._table("t_coupon")

    @property
    def delivery(self) -> DataFrame:
        return self._table("t_delivery")

    @property
    def feedback(self) -> DataFrame:
        return self._table("t_feedback")
