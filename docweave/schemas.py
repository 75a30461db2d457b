"""Explicit schemas for every record shape (no inference anywhere)."""

from pyspark.sql import types as T

S, L, I, D, B, FL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.FloatType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


VECTOR_METADATA = T.StructType([
    _f("filename", S), _f("file_size", L), _f("creation_date", S), _f("last_modified", S),
    _f("num_pages", I), _f("author", S), _f("creation_date_pdf", S),
    _f("chunk_id", I), _f("chunk_text", S),
])

VECTOR_OBJECT = T.StructType([
    _f("id", S), _f("values", T.ArrayType(FL)), _f("metadata", VECTOR_METADATA),
])

DOC_PROFILE = T.StructType([
    _f("name", S), _f("size", L), _f("created_time", D), _f("modified_time", D),
    _f("is_text_based", B), _f("is_scanned", B), _f("page_count", I),
    _f("has_images", B), _f("has_tables", B), _f("estimated_word_count", I),
])

SECTION = T.StructType([_f("type", S), _f("content", S)])
SECTIONED_PAGE = T.StructType([_f("title", S), _f("sections", T.ArrayType(SECTION))])

MATCH = T.StructType([_f("qid", L), _f("rank", I), _f("id", S), _f("score", D)])

INDEX_STATS = T.StructType([_f("dimension", I), _f("index_fullness", D), _f("total_vector_count", L)])

RELATIONSHIP = T.StructType([_f("type", S), _f("target", S)])
CONCEPT = T.StructType([
    _f("concept", S), _f("definition", S), _f("properties", T.MapType(S, S)),
    _f("relationships", T.ArrayType(RELATIONSHIP)),
])
NODES = T.StructType([_f("id", S), _f("definition", S), _f("properties", T.MapType(S, S)),
                      _f("verified", B)])
EDGES = T.StructType([_f("src", S), _f("dst", S), _f("type", S)])

TEST_CASE = T.StructType([_f("type", S), _f("question", S), _f("concepts", T.ArrayType(S)),
                          _f("ground_truth", S)])
BENCHMARK_RUN = T.StructType([_f("case_id", L), _f("model", S), _f("query_type", S),
                              _f("correct", B), _f("response_time", D)])
CHAT_MESSAGE = T.StructType([_f("conv_id", L), _f("turn", I), _f("role", S), _f("text", S)])

# Input tables, declared so reading them needs no schema inference (no
# footer-reading job per read) and types are fixed.
TABLE_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
