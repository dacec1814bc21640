"""Stand-ins: the tables at hand bound to the roles of an issue tracker.

``Tracker(spark, folder)`` yields the four raw string tables (orders -> issues,
conversations -> comments, events -> changelog, lineitem -> issuelinks) and the
tables derived from them with the library's operators, plus ``vectors``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake import constants as C
from triagelake.operators import features, marts, staging
from triagelake.session import materialise

# fixed values of the binding
PROJECT = "MAIN"
SPLIT_BOUNDS = ("1999-01-01", "2000-01-01", "2001-01-01")
SEGMENT_TYPES = [
    ("BUILDING", "Bug"), ("AUTOMOBILE", "Improvement"),
    ("MACHINERY", "Technical task"), ("HOUSEHOLD", "Test"),
]  # FURNITURE stays as it is and is unknown to the seed
FLAG_RESOLUTIONS = [
    ("AF", "Fixed"), ("AO", "Done"), ("RF", "Won't Do"), ("RO", "Duplicate"),
    ("NF", "Cannot Reproduce"),
]  # NO stays as it is and is unknown to the seed
PRIORITY_NAMES = [
    ("1", "Blocker"), ("2", "Critical"), ("3", "Major"), ("4", "Minor"), ("5", "Trivial"),
]
EVENT_FIELDS = [
    ("view", "Status"), ("purchase", "Priority"), ("click", "Assignee"),
    ("signup", "Resolution"), ("error", "issuetype"),
]
EVENT_PRIORITIES = ["Trivial", "Minor", "Major", "Critical", "Blocker", "P?"]


def _mapped(x: Column, pairs: list[tuple[str, str]], default: Column | None = None) -> Column:
    out = None
    for old, new in pairs:
        out = F.when(x == old, new) if out is None else out.when(x == old, new)
    return out if default is None else out.otherwise(default)


def _key(x: Column) -> Column:
    return F.concat(F.lit("TKT-"), x.cast("string"))


class Tracker:
    """Lazy frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- raw ---------------------------------------------------------------

    def first_lines(self) -> DataFrame:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
        lines = self.table("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", *order)
        return staging.keep_first(lines, ["l_orderkey"], order)

    def line_facts(self) -> DataFrame:
        """Supplier and flags of the first line and the last ship date per order, in
        one pass that is combined in the map tasks."""
        order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
        first = F.struct("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("flags"))
        return (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(F.min_by(first, order).alias("_first"), F.max("l_shipdate").alias("last_ship"))
            .select("l_orderkey", "_first.*", "last_ship")
        )

    def raw_issues(self) -> DataFrame:
        orders = self.table("orders")
        customers = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        suppliers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
        documents = self.table("documents").select("doc_id", "text")
        n_docs = self.table("documents").agg(F.max("doc_id") + 1).scalar()
        joined = (
            orders.withColumnRenamed("o_orderkey", "l_orderkey")
            .join(self.line_facts(), "l_orderkey", "left")
            .withColumn("doc_id", F.pmod("l_orderkey", n_docs))
            .join(customers, "o_custkey", "left")
            .join(suppliers, "l_suppkey", "left")
            .join(documents, "doc_id", "left")
        )
        day = "yyyy-MM-dd HH:mm:ss"
        return joined.select(
            F.col("l_orderkey").cast("string").alias("id"),
            _key(F.col("l_orderkey")).alias("key"),
            F.substring("text", 1, 120).alias("summary"),
            F.col("text").alias("description"),
            F.date_format("o_orderdate", day).alias("created"),
            F.when(F.col("o_orderstatus") == "P", "")
            .otherwise(F.date_format("last_ship", day))
            .alias("resolutiondate"),
            _mapped(F.col("c_mktsegment"), SEGMENT_TYPES, F.col("c_mktsegment")).alias("issuetype_name"),
            _mapped(F.col("flags"), FLAG_RESOLUTIONS, F.col("flags")).alias("resolution_name"),
            F.col("flags").alias("resolution_description"),
            _mapped(F.substring("o_orderpriority", 1, 1), PRIORITY_NAMES).alias("priority_name"),
            F.col("o_orderstatus").alias("status_name"),
            F.when(F.col("flags").isNull(), "SIDE").otherwise(PROJECT).alias("project_key"),
            F.when(F.col("l_suppkey") % 10 == 0, " ").otherwise(F.col("s_name")).alias("assignee"),
            F.col("o_custkey").cast("string").alias("reporter"),
            F.col("o_custkey").cast("string").alias("creator"),
            F.when(F.col("o_custkey") % 11 == 0, "n/a")
            .otherwise((F.col("o_custkey") % 17).cast("string"))
            .alias("votes_votes"),
            (F.col("o_custkey") % 23).cast("string").alias("watches_watchcount"),
        )

    def raw_comments(self) -> DataFrame:
        said = F.timestamp_add("MINUTE", F.col("turn").cast("int"), F.lit("2020-01-01").cast("timestamp_ntz"))
        edited = F.timestamp_add("HOUR", F.lit(1), said)
        stamp = "yyyy-MM-dd HH:mm:ss"
        return self.table("conversations").select(
            _key(F.col("conv_id")).alias("key"),
            F.concat_ws("-", "conv_id", "turn").alias("comment_id"),
            F.col("role").alias("comment_author"),
            F.col("text").alias("comment_body"),
            F.date_format(said, stamp).alias("comment_created"),
            F.date_format(edited, stamp).alias("comment_updated"),
        )

    def raw_changelog(self) -> DataFrame:
        number = F.col("user_id") * 30 + F.day("ts") - 1
        names = F.array(*[F.lit(p) for p in EVENT_PRIORITIES])

        def priority(shift: int) -> Column:
            return F.get(names, ((F.col("event_id") + shift) % len(EVENT_PRIORITIES)).cast("int"))

        is_priority = F.col("event_type") == "purchase"
        value = F.get_json_object("props", "$.k")
        return self.table("events").select(
            _key(number).alias("key"),
            value.alias("author"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("created"),
            _mapped(F.col("event_type"), EVENT_FIELDS).alias("field"),
            F.when(is_priority, priority(1)).alias("fromstring"),
            F.when(is_priority, priority(0)).otherwise(value).alias("tostring"),
        )

    def raw_links(self) -> DataFrame:
        flags = F.concat("l_returnflag", "l_linestatus")
        kinds = [("A", "Duplicate"), ("R", "Blocks")]
        rest = F.when(flags == "NF", "Relates").otherwise("is clones of")
        other = F.col("l_partkey").cast("string")
        return self.table("lineitem").select(
            _key(F.col("l_orderkey")).alias("key"),
            _mapped(F.col("l_returnflag"), kinds, rest).alias("type_name"),
            F.when(F.col("l_linestatus") == "F", other).alias("inwardissue_key"),
            F.when(F.col("l_linestatus") == "O", other).alias("outwardissue_key"),
        )

    # --- staging -----------------------------------------------------------

    def issues(self) -> DataFrame:
        return staging.stage_issues(self.raw_issues(), PROJECT)

    def comments(self) -> DataFrame:
        return staging.stage_comments(self.raw_comments(), self.issues())

    def changelog(self) -> DataFrame:
        return staging.stage_changelog(self.raw_changelog(), self.issues())

    def links(self) -> DataFrame:
        return staging.stage_links(self.raw_links(), self.issues())

    # --- features: known keys are a subset of the staged keys, so the features
    # start from the typed tables and meet the issues once ---------------------

    def cleaned(self) -> DataFrame:
        return features.clean_issues(self.issues(), SPLIT_BOUNDS)

    def comment_features(self) -> DataFrame:
        return features.comment_features(staging.type_comments(self.raw_comments()), self.cleaned())

    def change_features(self, include_initial: bool = False) -> DataFrame:
        return features.change_features(
            staging.type_changelog(self.raw_changelog()), self.cleaned(), include_initial
        )

    def link_features(self) -> DataFrame:
        return features.link_features(staging.type_links(self.raw_links()), self.cleaned())

    # --- marts ---------------------------------------------------------------

    def all_change_features(self) -> DataFrame:
        """For readers that join the issues themselves."""
        return features.change_features(staging.type_changelog(self.raw_changelog()))

    def all_links_mart(self) -> DataFrame:
        return marts.links_mart(features.link_features(staging.type_links(self.raw_links())))

    # the left joins drop unknown keys, so the features skip their own filter

    def ml_mart(self, issues: DataFrame | None = None) -> DataFrame:
        return marts.ml_mart(
            self.cleaned() if issues is None else issues,
            features.comment_features(staging.type_comments(self.raw_comments())),
            features.change_features(staging.type_changelog(self.raw_changelog())),
            features.link_features(staging.type_links(self.raw_links())),
        )

    def ops_mart(self) -> DataFrame:
        stats = features.comment_stats(
            features.clean_comments(staging.type_comments(self.raw_comments()))
        )
        return marts.ops_mart(self.cleaned(), stats)

    def workload_mart(self) -> DataFrame:
        return marts.workload_mart(self.cleaned())

    def links_mart(self) -> DataFrame:
        return marts.links_mart(self.link_features())

    # --- vectors ---------------------------------------------------------------

    def vectors(self) -> DataFrame:
        """Mart rows that have a vector, with two unit-length views: elements
        1-32 and 33-64 of the embedding."""
        def unit(x: Column) -> Column:
            x = F.transform(x, lambda v: v.cast("double"))
            norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v))
            return F.transform(x, lambda v: v / norm)

        views = self.table("embeddings").select(
            _key(F.col("vec_id")).alias("key"),
            unit(F.slice("embedding", 1, 32)).alias("vec_a"),
            unit(F.slice("embedding", 33, 32)).alias("vec_b"),
        )
        # only tickets with a vector go through typing, cleaning and the wide join: what a ticket
        # is made of has its key, so rows of other keys are left out where they are read
        wanted = Wanted(self.spark, self.folder, materialise(views.select("key").distinct(), "wanted"))
        return wanted.ml_mart().join(views, "key").select(
            "key", "split", "issuetype", "resolution", "priority", "status", "reporter",
            "summary_clean", "description_clean", "comments_concat", "text_noco", "text_rich",
            *C.CHANGE_FEATURES, "vec_a", "vec_b",
        )


class Wanted(Tracker):
    """The same frames for the tickets of some keys alone."""

    def __init__(self, spark: SparkSession, folder: str, keys: DataFrame):
        super().__init__(spark, folder)
        self.keys = keys

    def table(self, name: str) -> DataFrame:
        rows = super().table(name)
        if name in ("orders", "lineitem"):
            key = _key(F.col("o_orderkey" if name == "orders" else "l_orderkey"))
            return staging.only_known_keys(rows.withColumn("key", key), self.keys).select(*rows.columns)
        return rows

    def raw_comments(self) -> DataFrame:
        return staging.only_known_keys(super().raw_comments(), self.keys)

    def raw_changelog(self) -> DataFrame:
        return staging.only_known_keys(super().raw_changelog(), self.keys)
