"""Collections, facts and batches derived from the given tables. ``plans/oracles.py`` spells
the same views in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.metadata import with_promoted
from ..functions.names import entity_slug, predicate_slug
from ..schemas import COLLECTION_SCHEMA, ENTITY_SCHEMA, PROVENANCE, TRIPLE_SCHEMA
from ..sources.tables import is_file

BATCH_TS = "2026-01-01 00:00:00"
BASE_TS = "2025-01-01 00:00:00"
DIM = 64


# The given tables, stated so that opening one runs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
}


class Tables:
    """The Parquet tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name, key) -> DataFrame:
        """A table for heavy work per row. One kept in a single file would be read by a single
        task, so its rows are dealt out by ``key`` first; a folder of files is left as it is."""
        rows = getattr(self, name)
        if not is_file(self.spark, f"{self.folder}/{name}.parquet"):
            return rows
        return rows.repartition(self.spark.sparkContext.defaultParallelism, key)


# -- collections --------------------------------------------------------------------------

NOTE_METADATA = """concat('{"wing":"', lang, '"',
    case when n_chars >= 500 then concat(',"room":"', source, '"') else '' end,
    ',"source_file":"corpus/', lang, '/', source, '.txt","chunk":', cast(n_chars div 1000 as string),
    ',"pinned":', case when n_chars >= 5000 then 'true' else 'false' end, '}')"""


def note_rows(t: Tables) -> DataFrame:
    """One collection row per document, without vectors."""
    return t.spread("documents", "doc_id").selectExpr(
        "concat('doc_', doc_id) AS id", "text AS document", f"{NOTE_METADATA} AS metadata", "doc_id"
    )


def notes(t: Tables) -> DataFrame:
    """The main collection: documents with the vector of the same number, where there is one."""
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding")
    joined = note_rows(t).join(vectors, "doc_id", "left")
    return with_promoted(joined).select(COLLECTION_SCHEMA.names)


def bare_notes(t: Tables) -> DataFrame:
    """The same rows for plans that never look at a vector: no join is needed."""
    return with_promoted(note_rows(t)).drop("doc_id")


def talks(t: Tables) -> DataFrame:
    """Conversation turns as collection rows."""
    return t.conversations.selectExpr(
        "concat('talk_', conv_id, '_', turn) AS id",
        "text AS document",
        """concat('{"wing":"', role, '","room":"', conv_id, '"}') AS metadata""",
        "conv_id",
        "turn",
    )


def labelled(t: Tables) -> DataFrame:
    """Documents that have labels, with them."""
    return t.documents.join(t.labels, "doc_id")


def prototypes(t: Tables) -> DataFrame:
    """Query vectors: the mean vector of each label."""
    means = (
        t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    return means.groupBy(F.col("label").cast("long").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda c: c.x).alias("embedding")
    )


def centre(t: Tables) -> DataFrame:
    """One query vector: the mean of all vectors."""
    means = (
        t.embeddings.select(F.posexplode("embedding").alias("i", "x"))
        .groupBy("i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
    )
    return means.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda c: c.x).alias("embedding")
    ).select(F.lit(0).cast("long").alias("query_id"), "embedding")


def mixed_entries(t: Tables) -> DataFrame:
    """An incoming batch of which part cannot be stored: ids too long, metadata that is a URL
    query string, vectors one component short."""
    said = t.conversations.selectExpr(
        "concat(role, ':', text) AS id",
        "text AS document",
        """concat('{"wing":"', role, '","room":"', conv_id, '"}') AS metadata""",
        "CAST(NULL AS array<float>) AS embedding",
    )
    seen = t.pages.selectExpr(
        "url AS id",
        "html AS document",
        """CASE WHEN url LIKE '%?%' THEN substring_index(url, '?', -1)
                ELSE concat('{"source_file":"', url, '"}') END AS metadata""",
        "CAST(NULL AS array<float>) AS embedding",
    )
    vectors = t.embeddings.selectExpr(
        "concat('vec_', vec_id) AS id",
        "CAST(NULL AS string) AS document",
        """concat('{"room":"', label, '"}') AS metadata""",
        "CASE WHEN label = 9 THEN slice(embedding, 1, 63) ELSE embedding END AS embedding",
    )
    return said.unionByName(seen).unionByName(vectors)


def files(t: Tables) -> DataFrame:
    """Source files behind the documents: path, rows, whether any of them is labelled."""
    return (
        t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
        .groupBy(
            F.expr("concat('corpus/', lang, '/', source, '/', n_chars div 1000, '.jsonl')").alias("path")
        )
        .agg(
            F.max("doc_id").cast("double").alias("mtime"),
            F.count("*").alias("drawers"),
            F.count("quality").alias("n_labelled"),
        )
    )


def manifest(t: Tables) -> DataFrame:
    return files(t).select(
        "path",
        F.when(F.col("n_labelled") > 0, "done").otherwise("pending").alias("status"),
        "mtime",
        "drawers",
        F.lit(BATCH_TS).cast("timestamp").alias("ts"),
    )


# -- facts --------------------------------------------------------------------------------

SEQ = """CAST(CAST(l_orderkey AS decimal(18,0)) * 1000000000000000000
    + CAST(l_linenumber AS decimal(18,0)) * 100000000000000000
    + CAST(l_partkey AS decimal(18,0)) * 100000
    + datediff(l_shipdate, date'1970-01-01') AS decimal(38,0))"""
VALID_FROM = """CASE WHEN o_orderpriority = '5-LOW' THEN NULL
    WHEN l_returnflag = 'A' THEN concat(CAST(CAST(l_shipdate AS date) AS string), 'T00:00:00Z')
    ELSE CAST(CAST(l_shipdate AS date) AS string) END"""
ENDED = "CAST(date_add(CAST(l_shipdate AS date), l_linenumber * 30) AS string)"


def _lines(t: Tables) -> DataFrame:
    return (
        t.spread("lineitem", "l_orderkey").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    )


def purchases(t: Tables) -> DataFrame:
    """Facts to add, one per order line, by name: who bought or sent back what, and when."""
    return _lines(t).selectExpr(
        f"{SEQ} AS seq",
        "c_name AS subject",
        "CASE WHEN l_returnflag = 'R' THEN 'Sent Back' ELSE 'Bought Item' END AS predicate",
        "p_name AS object",
        f"{VALID_FROM} AS valid_from",
        f"CASE WHEN l_linestatus = 'O' THEN NULL ELSE {ENDED} END AS valid_to",
        "CASE WHEN l_discount > 0 THEN 1 - l_discount END AS confidence",
        "o_orderstatus AS source_closet",
        "o_orderpriority AS adapter_name",
        "l_shipdate",
        "o_orderdate",
    )


def triples(t: Tables) -> DataFrame:
    """Stored facts, one per order line, for the reading queries."""
    absent = {c: F.lit(None).cast("string") for c in ("source_file", "source_drawer_id")}
    return (
        purchases(t)
        .withColumns(
            {
                "id": F.concat(F.lit("f_"), F.col("seq").cast("string")),
                "subject": entity_slug("subject"),
                "predicate": predicate_slug("predicate"),
                "object": entity_slug("object"),
                "confidence": F.coalesce("confidence", F.lit(1.0)),
                "extracted_at": F.lit(BASE_TS).cast("timestamp"),
                **absent,
            }
        )
        .select(TRIPLE_SCHEMA.names)
    )


def _entities(rows: DataFrame, name: str, kind: str) -> DataFrame:
    return (
        rows.select(entity_slug(name).alias("id"), F.col(name).alias("name"))
        .distinct()
        .withColumns(
            {
                "type": F.lit(kind),
                "properties": F.lit(None).cast("string"),
                "created_at": F.lit(BASE_TS).cast("timestamp"),
            }
        )
        .select(ENTITY_SCHEMA.names)
    )


def customers(t: Tables) -> DataFrame:
    return _entities(t.customer, "c_name", "customer")


def entities(t: Tables) -> DataFrame:
    """Customers and parts; one part is missing, so that its facts drop out of the joins."""
    parts = _entities(t.part.filter("p_name <> 'red bolt'"), "p_name", "part")
    return customers(t).unionByName(parts)


def usage_events(t: Tables) -> DataFrame:
    """A sequence of fact events: errors end a user's subscription, all else starts one, which
    takes effect ``value`` hours later."""
    stamp = "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    later = stamp.format("ts + make_interval(0, 0, 0, 0, CAST(floor(value) AS int))")
    return t.spread("events", "event_id").selectExpr(
        "event_id AS seq",
        "CASE WHEN event_type = 'error' THEN 'end' ELSE 'add' END AS kind",
        "concat('User ', user_id) AS subject",
        "'Subscribed To' AS predicate",
        "'Service' AS object",
        f"CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE {later} END AS valid_from",
        f"CASE WHEN event_type = 'purchase' THEN {stamp.format('ts + make_dt_interval(30)')} END AS valid_to",
        f"CASE WHEN event_type = 'error' THEN {stamp.format('ts')} END AS ended",
    )


def subscriptions(t: Tables) -> DataFrame:
    """Stored facts with up to three open ones per user, and finished ones."""
    absent = {c: F.lit(None).cast("string") for c in PROVENANCE}
    return (
        t.customer.filter("c_custkey % 3 <> 0")
        .selectExpr(
            "concat('s_', c_custkey) AS id",
            "concat('user_', c_custkey % 50) AS subject",
            "'subscribed_to' AS predicate",
            "'service' AS object",
            "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('2024-01-', lpad(CAST(c_custkey % 28 + 1 AS string), 2, '0')) END AS valid_from",
            "CASE WHEN c_custkey > 150 THEN '2024-06-01' END AS valid_to",
            "1D AS confidence",
        )
        .withColumns({**absent, "extracted_at": F.lit(BASE_TS).cast("timestamp")})
        .select(TRIPLE_SCHEMA.names)
    )


def people(t: Tables) -> DataFrame:
    """Person records from customers and their nations."""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    # a record becomes many facts and mentions; adaptive execution, which sees the records only, would
    # leave them to one task
    return rows.repartition(t.spark.sparkContext.defaultParallelism, "c_custkey").selectExpr(
        "c_custkey AS seq",
        "lower(c_name) AS key",
        "CASE WHEN c_acctbal > 5000 THEN concat(\"O'\", c_name) END AS full_name",
        "CASE WHEN c_acctbal < 0 THEN 'debtor' END AS type",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'f' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'm' END AS gender",
        "CASE WHEN c_acctbal > 2000 THEN '1990-05-06' END AS birthday",
        "CASE WHEN c_acctbal > 3000 THEN lower(n_name) END AS parent",
        "CASE WHEN c_acctbal > 4000 THEN lower(r_name) END AS partner",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'daughter' WHEN 'AUTOMOBILE' THEN 'husband'
             WHEN 'MACHINERY' THEN 'brother' WHEN 'HOUSEHOLD' THEN 'dog' END AS relationship""",
        "CASE WHEN c_acctbal > 6000 THEN n_name END AS sibling",
        "CASE WHEN c_acctbal > 7000 THEN r_name END AS owner",
        "CASE WHEN c_acctbal > 0 THEN array(lower(r_name), lower(c_mktsegment)) ELSE array() END AS interests",
    )
