"""Explicit schemas (no inference anywhere) for the data model D1-D13."""

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
F32 = T.FloatType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# D1 / SC1 / SC3: NewsAPI- and GNews-shaped poll envelope, one JSON object per poll.
ARTICLE_STUB = T.StructType([_f("title", S), _f("url", S), _f("publishedAt", S)])
POLL_NEWSAPI = T.StructType([
    _f("run_id", S), _f("source", S), _f("poll_no", I), _f("status", I),
    _f("totalResults", L), _f("articles", T.ArrayType(ARTICLE_STUB)),
])

# D2 / SC2: Guardian-shaped envelope with the body inline.
GUARDIAN_RESULT = T.StructType([
    _f("webPublicationDate", S),
    _f("fields", T.StructType([_f("headline", S), _f("body", S)])),
])
POLL_GUARDIAN = T.StructType([
    _f("run_id", S), _f("source", S), _f("poll_no", I), _f("status", I),
    _f("response", T.StructType([_f("results", T.ArrayType(GUARDIAN_RESULT))])),
])

# D3 / SC4: landed page.
PAGES = T.StructType([_f("url", S), _f("status", I), _f("html", S)])

# Article stub in arrival order.
ARTICLES = T.StructType([
    _f("run_id", S), _f("source", S), _f("poll_no", I), _f("pos", I),
    _f("title", S), _f("url", S), _f("publishdate", S), _f("content", S),
])

# Poll table: one row per poll, zero-article polls included.
POLLS = T.StructType([
    _f("run_id", S), _f("source", S), _f("poll_no", I), _f("status", I), _f("total_results", L),
])

# D5 / D6 / D7.
CHUNKS = T.StructType([
    _f("source", S), _f("title", S), _f("publishdate", S), _f("chunk_idx", I), _f("content", S),
])
POINTS = T.StructType([
    _f("point_id", S), _f("embedding", T.ArrayType(F32)), _f("title", S),
    _f("content", S), _f("publishdate", S), _f("chunk_idx", I), _f("source", S),
])

# D8-D10 count tables.
VECTOR_COUNTS = T.StructType([_f("date", S), _f("vector_count", L)])
ARTICLE_COUNTS = T.StructType([_f("date", S), _f("source", S), _f("nb_article", L)])
DAILY_COUNTS = T.StructType([_f("date", S), _f("source", S), _f("count", L)])

# D11 Q&A log.
QA = T.StructType([
    _f("question", S), _f("answer", S), _f("upvote", I), _f("downvote", I),
    _f("flag", I), _f("timestamp", T.TimestampType()),
])
QA_COLUMNS = ["question", "answer", "upvote", "downvote", "flag", "timestamp"]

# D12 token states: per-chunk hidden states and attention mask.
TOKEN_STATES = T.StructType([
    _f("chunk_id", S), _f("states", T.ArrayType(T.ArrayType(F32))), _f("mask", T.ArrayType(I)),
])

# D13 source registry and extraction rules: their schemas live with the rows
# in ``sources/registry.py`` (SOURCES_SCHEMA, RULES_SCHEMA).
