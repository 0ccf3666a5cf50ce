"""Entity fixtures derived from the driver's tables (see FIXTURES.md §2).

W (wide entity table), E (event amounts by pivot), P (prediction long
table), V (vectors) and D (labelled text).  Each builder returns a lazy
DataFrame; the matching DuckDB text is in :mod:`tessera.sources.fixture_sql`.

Scale notes for W: the member number is a window partitioned by the order
key on ``lineitem`` alone, so the following join with ``orders`` on the same
key reuses that hash partitioning (only ``orders`` is exchanged).  Customers are joined to the
orders before that, so their key never shuffles the rows of ``lineitem``.  Customer
and part joins are left to AQE, which broadcasts them only when the runtime
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise keeps a
sort-merge join.  ``nation``/``region`` are the fixed 25/5-row dimensions and
are broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.tables import table

# Column numbers of the deterministic null pattern (FIXTURES.md §2, fixed values)
NULL_SLOTS = {
    "home": 1, "dest": 2, "vip": 3, "flag": 4, "code": 5, "age": 6,
    "a1": 7, "a2": 8, "a3": 9, "a4": 10, "a5": 11, "name": 12,
}
AMOUNTS = ["a1", "a2", "a3", "a4", "a5"]
CATEGORICALS = ["home", "dest", "vip", "flag", "code", "name"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FAMILIES = [1, 2, 3, 4]


def _nulled(value: Column, slot: int) -> Column:
    hit = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13 + F.col("l_partkey") * 3 + F.lit(slot)) % 50 == 0
    return F.when(hit, F.lit(None)).otherwise(value)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture W: one row per lineitem with id, categories, amounts, label, split."""
    li = table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    member = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"
    )
    li = li.withColumn("member_no", F.row_number().over(member).cast("int"))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    geo = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey").join(
        F.broadcast(table(spark, sf_dir, "region", "r_regionkey", "r_name")),
        F.col("n_regionkey") == F.col("r_regionkey"),
    )
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size")
    buyers = orders.join(customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")), F.col("o_custkey") == F.col("c_custkey"))
    j = li.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    zero = F.col("l_tax") == 0
    amounts = {
        "a1": F.col("l_quantity"),
        "a2": F.col("l_extendedprice"),
        "a3": F.col("l_extendedprice") * F.col("l_discount"),
        "a4": F.col("l_extendedprice") * F.col("l_tax"),
        "a5": F.col("l_quantity") * F.col("l_tax"),
    }
    raw = {
        "home": F.col("r_name"),
        "dest": F.col("p_type"),
        "vip": F.when(F.col("c_mktsegment") == "BUILDING", "True").otherwise("False"),
        "flag": F.when(zero, "True").otherwise("False"),
        "code": F.concat_ws("/", F.col("p_type"), F.col("p_size").cast("string"), F.col("l_linestatus")),
        "age": F.floor(F.col("c_acctbal") / 98).cast("double"),
        **{k: F.when(zero, F.lit(0.0)).otherwise(v).cast("double") for k, v in amounts.items()},
        "name": F.col("p_name"),
    }
    return j.select(
        F.col("member_no"),
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.col("member_no").cast("string")).alias("id"),
        *[_nulled(raw[c], NULL_SLOTS[c]).alias(c) for c in NULL_SLOTS],
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"),
    )


def group_of(id_col: str = "id") -> Column:
    """Group key of a W id (the part before the underscore)."""
    return F.split(F.col(id_col), "_", 2).getItem(0)


def events_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture E: per (user_id, day) sum of value by event type; absent type = null."""
    ev = table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    return (
        ev.groupBy("user_id", F.to_date("ts").alias("day"))
        .pivot("event_type", EVENT_TYPES)
        .agg(F.sum("value"))
    )


def predictions(spark: SparkSession, sf_dir: str, w: DataFrame | None = None) -> DataFrame:
    """Fixture P: long table (id, split, y, family, p) for families f1..f4.

    ``p`` is a deterministic hash-like number in (0, 1); family f1 carries a
    label signal of +0.2*y (clipped at 0.999) so best-threshold searches are
    not all ties.
    """
    w = w if w is not None else wide(spark, sf_dir)
    fam = F.explode(F.array(*[F.lit(i) for i in FAMILIES])).alias("fam")
    base = w.select("id", "split", "y", "member_no", group_of().cast("bigint").alias("okey"), fam)
    h = F.col("okey") * 7919 + F.col("member_no") * 104729 + F.col("fam") * 1299709
    p0 = ((h % 10007) + F.lit(0.5)) / F.lit(10007.0)
    p = F.when(F.col("fam") == 1, F.least(p0 + F.col("y") * 0.2, F.lit(0.999))).otherwise(p0)
    return base.select(
        "id", "split", "y", F.concat(F.lit("f"), F.col("fam").cast("string")).alias("family"), p.alias("p")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture V: embeddings (vec_id, embedding array<float>, label)."""
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture D: documents joined to their quality/toxic labels."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return docs.join(labels, "doc_id")
