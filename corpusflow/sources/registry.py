"""SC5 / D13: the source registry (F1-F27) and the extraction rules (X0-X26) as data.

One operator plus these rows replaces one hand-written fetcher and scraper
per site: adding a site is adding a row. Both tables are small config
(bounded by the number of configured sites); Spark broadcasts them by size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _sel(tag=None, cls=None, id=None, cls_contains=None):  # noqa: A002
    return {"tag": tag, "cls": cls, "id": id, "cls_contains": cls_contains}


P = _sel("p")

# ---------------------------------------------------------------------------
# Container classes, ids, dropped blocks, paragraph filters and
# deleted phrases per site, exactly as the sites' scrapers select them.
_R = [
    dict(rule_id="X1", container=None, text_mode="para", strip=False, joiner=" ", status_policy="none"),
    dict(rule_id="X2", container=_sel("div", "wysiwyg wysiwyg--all-content css-ibbk12"),
         drops=[_sel("div", "more-on"), _sel("div", "article-source"),
                _sel("div", "article-info-block css-ti04u9"), _sel("figure")],
         text_mode="all", separator="\n", strip=True, regex_deletes=[r"list \d+ of \d+"], collapse=True,
         status_policy="none"),
    dict(rule_id="X3", container=_sel("div", "xvlfx ZRifP TKoO eaKKC bOdfO"), text_mode="all", separator="\n",
         strip=True, collapse=True, status_policy="none"),
    dict(rule_id="X4", container=_sel("div", "LayoutContainer_container__jw05j Article_body__y7ykc"),
         para_drops=[_sel("em")], text_mode="para", strip=False, joiner="\n", missing="empty", status_policy="lt400"),
    dict(rule_id="X5", container=_sel("div", "article__content-container"),
         para=_sel("p", "paragraph inline-placeholder"), text_mode="para", strip=False, joiner="",
         status_policy="eq200"),
    dict(rule_id="X6", container=_sel("div", "article-content"),
         drops=[_sel("div", "featured featured-video video-ct"), _sel("figure"), _sel("div", "author-bio")],
         text_mode="para", strip=True, joiner="\n",
         literal_deletes=["FIRST ON FOX:", "CLICK HERE TO GET THE FOX NEWS APP"], collapse=True,
         status_policy="none"),
    dict(rule_id="X7", container=_sel("div", "meteredContent grid-center"),
         drops=[_sel("figure"), _sel("div", " mb-md hide-for-print"), _sel("div", id="gift-share-inline")],
         text_mode="all", separator="\n", strip=True, collapse=True, status_policy="none"),
    dict(rule_id="X8", container=_sel("div", id="storytext"), container_all=True,
         drops=[_sel("a"), _sel("figure"), _sel("div", "bucketwrap image large")],
         text_mode="para", strip=True, suffix=" \n", status_policy="lt400"),
    dict(rule_id="X9", container=_sel("div", "RichTextStoryBody RichTextBody"), text_mode="para", strip=True,
         suffix="\n\n", trim=True, status_policy="lt400"),
    dict(rule_id="X10", container=_sel("main", id="main"), text_mode="para", strip=False,
         skip_if_contains=["Stay up on the very latest with Evening Update"], piece_deletes=["Submit"],
         suffix="\n", literal_deletes=["Thanks for contacting us. We've received your submission.", "Advertisement"],
         trim=True, status_policy="eq200"),
    dict(rule_id="X11", container=_sel("div", "gnt_ar_b"), drop_last=1, fallback=_sel("div", id="content-container"),
         fallback_drop_last=2, text_mode="para", strip=True, joiner="\n", trim=True, status_policy="eq200"),
    dict(rule_id="X12", container=_sel("div", "section-wrap"), inner=_sel("div", "sdc-article-body sdc-article-body--lead"),
         text_mode="para", strip=False, joiner="", status_policy="eq200"),
    dict(rule_id="X13", container=_sel("div", "paywall"), container_all=True, text_mode="para", strip=False,
         joiner="\n", missing="empty", status_policy="lt400"),
    dict(rule_id="X14", container=_sel("article"), container_all=True, text_mode="all", separator="", strip=True,
         suffix="\n\n", trim=True, missing="empty", status_policy="none"),
    dict(rule_id="X15", container=_sel("div", "caas-body-content"), text_mode="para", strip=True, suffix="\n",
         status_policy="lt400"),
    dict(rule_id="X16", container=_sel("div", "article-body fs-article fs-responsive-text current-article"),
         container_all=True, drops=[_sel("figure")], text_mode="para", strip=True, joiner="", status_policy="lt400"),
    dict(rule_id="X17", container=_sel("div", "group"), container_all=True, drops=[_sel("em"), _sel("a")],
         text_mode="para", strip=True, suffix=" \n", status_policy="lt400"),
    dict(rule_id="X18", container=_sel("section", "at-body"), drops=[_sel("i")], text_mode="para", strip=True,
         suffix="\n", trim=True, status_policy="lt400"),
    dict(rule_id="X19", container=_sel("div", "content-inner"), text_mode="para", strip=True, suffix=" \n",
         trim=True, status_policy="lt400"),
    dict(rule_id="X20", container=_sel("div", "WYSIWYG articlePage"), text_mode="para", strip=True, suffix=" \n",
         regex_deletes=[r"By.*\n", r"\(Reporting and writing by.*\)"], trim=True, status_policy="lt400"),
    dict(rule_id="X21", container=_sel("div", "post-article-content"), drops=[_sel("figure")], text_mode="para",
         strip=True, suffix=" \n", trim=True, status_policy="lt400"),
    dict(rule_id="X22", container=_sel("div", "body__inner-container"), container_all=True, text_mode="para",
         strip=False, joiner="", status_policy="eq200"),
    dict(rule_id="X23", container=_sel("div", "gnt_ar_b"), text_mode="para", strip=False,
         skip_if_contains=["Swapna Venugopal Ramaswamy is a White House Correspondent for USA TODAY."
                           "You can follow her on X @SwapnaVenugopal"],
         piece_deletes=["Submit"], suffix="\n", trim=True, status_policy="eq200"),
    dict(rule_id="X24", container=_sel("article", "single-post-wrapper"), container_all=True, text_mode="para",
         strip=False, suffix="\n", trim=True, status_policy="eq200"),
    dict(rule_id="X25", container=_sel("div", "content-lock-content"), text_mode="para", strip=False, suffix="\n",
         trim=True, status_policy="eq200"),
    dict(rule_id="X26", container=_sel("div", "entry-content"), drop_last=1, text_mode="para", strip=False,
         suffix="\n", trim=True, status_policy="eq200"),
]
# ---------------------------------------------------------------------------

_DEFAULTS = dict(container=None, container_all=False, inner=None, fallback=None, fallback_drop_last=0,
                 drops=[], para_drops=[], text_mode="para", para=P, strip=False, separator="", joiner="", suffix="",
                 drop_last=0, skip_if_contains=[], piece_deletes=[], literal_deletes=[], regex_deletes=[],
                 collapse=False, trim=False, missing="null", status_policy="eq200")

RULES: dict[str, dict] = {r["rule_id"]: {**_DEFAULTS, **r} for r in _R}

_SEL_T = T.StructType([T.StructField(k, T.StringType()) for k in ("tag", "cls", "id", "cls_contains")])
_ARR_S = T.ArrayType(T.StringType())
RULES_SCHEMA = T.StructType([
    T.StructField("rule_id", T.StringType()), T.StructField("container", _SEL_T),
    T.StructField("container_all", T.BooleanType()), T.StructField("inner", _SEL_T),
    T.StructField("fallback", _SEL_T), T.StructField("fallback_drop_last", T.IntegerType()),
    T.StructField("drops", T.ArrayType(_SEL_T)), T.StructField("para_drops", T.ArrayType(_SEL_T)), T.StructField("text_mode", T.StringType()),
    T.StructField("para", _SEL_T), T.StructField("strip", T.BooleanType()),
    T.StructField("separator", T.StringType()), T.StructField("joiner", T.StringType()),
    T.StructField("suffix", T.StringType()), T.StructField("drop_last", T.IntegerType()),
    T.StructField("skip_if_contains", _ARR_S), T.StructField("piece_deletes", _ARR_S),
    T.StructField("literal_deletes", _ARR_S), T.StructField("regex_deletes", _ARR_S),
    T.StructField("collapse", T.BooleanType()), T.StructField("trim", T.BooleanType()),
    T.StructField("missing", T.StringType()), T.StructField("status_policy", T.StringType()),
])


def rules_df(spark: SparkSession, rules: dict[str, dict] = RULES) -> DataFrame:
    rows = [tuple(r.get(f.name) for f in RULES_SCHEMA.fields) for r in rules.values()]
    return spark.createDataFrame(rows, RULES_SCHEMA)


# ---------------------------------------------------------------------------
# The collector's sources in run order (label, selector, rule,
# null policy, stop variant, status policy, active).
_S = [
    ("Guardian", "guardian", None, "X0", "never_null", "std", "none", True),
    ("BBC", "sources", "bbc-news", "X1", "never_null", "std", "stop", True),
    ("Al Jazeera", "sources", "al-jazeera-english", "X2", "truncate", "trailing_repeat", "stop", True),
    ("ABC", "sources", "abc-news", "X3", "truncate", "std", "stop", True),
    ("CNN", "sources", "cnn", "X5", "as_dup", "std", "skip", True),
    ("Fortune", "sources", "fortune", "X13", "truncate_skip_empty", "std", "stop", True),
    ("ABC AU", "sources", "abc-news-au", "X4", "truncate", "std", "stop", True),
    ("Fox News", "sources", "fox-news", "X6", "truncate", "std", "stop", True),
    ("Washington Post", "domains", "washingtonpost.com", "X7", "truncate", "std", "stop", True),
    ("Forbes", "domains", "forbes.com", "X16", "truncate", "std", "stop", True),
    ("CNBC", "domains", "cnbc.com", "X17", "truncate", "std", "stop", True),
    ("New York Post", "domains", "nypost.com", "X10", "truncate", "std", "stop", True),
    ("Wired", "domains", "wired.com", "X22", "truncate", "std", "stop", True),
    ("Ambcrypto", "domains", "ambcrypto.com", "X24", "truncate", "std", "stop", True),
    ("USA Today", "sources", "usa-today", "X11", "skip_falsy", "inpage", "stop", True),
    ("NPR", "domains", "npr.org", "X8", "truncate", "std", "stop", True),
    ("AP News", "domains", "apnews.com", "X9", "truncate", "std", "stop", True),
    ("Coindesk", "domains", "coindesk.com", "X18", "truncate", "std", "stop", True),
    ("Bitcoinist", "domains", "bitcoinist.com", "X19", "truncate", "std", "stop", True),
    ("Investing", "domains", "investing.com", "X20", "truncate", "std", "stop", True),
    ("Coinjournal", "domains", "coinjournal.net", "X21", "truncate", "std", "stop", True),
    ("business insider", "domains", "businessinsider.com", "X25", "truncate", "std", "stop", True),
    ("readwrite", "domains", "readwrite.com", "X26", "truncate", "std", "stop", True),
    ("sky sports", "domains", "skysports.com", "X12", "skip_falsy", "inpage", "stop", True),
    ("GNews", "gnews", None, "X14", "truncate", "cap", "stop", False),
    ("Engadget", "domains", "engadget.com", "X15", "truncate", "std", "stop", False),
    ("USA Today (finance)", "sources", "usa-today", "X23", "keep", "std", "stop", False),
]
# ---------------------------------------------------------------------------

# Request settings. Page size 100, a window of one day and language en
# unless listed; the topic asked for; GNews and CNN need the articles key.
DEFAULT_REQUEST = {"page_size": 100, "window_days": 1, "lang": "en", "topic": None, "country": None, "sort": "popularity", "strict": False}
REQUEST = {
    "Guardian": {"page_size": 200, "sort": "newest"},
    "Al Jazeera": {"topic": "general"},
    "ABC": {"topic": "general"},
    "CNN": {"strict": True},
    "Fortune": {"topic": "business"},
    "ABC AU": {"topic": "general", "window_days": None},
    "Fox News": {"topic": "general"},
    "sky sports": {"sort": "publishedAt"},
    "GNews": {"country": "us", "strict": True},
}
#: Values of ``sort`` that mean publish time, newest first.
NEWEST_FIRST = ("newest", "publishedAt")
# A source missing from the registry is fetched like the plain ones: all paragraphs of the page.
DEFAULT_RULE = "X1"

SOURCES_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("selector_kind", T.StringType()),
    T.StructField("selector", T.StringType()), T.StructField("rule_id", T.StringType()),
    T.StructField("null_policy", T.StringType()), T.StructField("stop_variant", T.StringType()),
    T.StructField("status_policy", T.StringType()), T.StructField("active", T.BooleanType()),
    T.StructField("page_size", T.IntegerType()), T.StructField("window_days", T.IntegerType()),
    T.StructField("lang", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("sort", T.StringType()),
    T.StructField("strict", T.BooleanType()),
])


def sources_df(spark: SparkSession, active_only: bool = True) -> DataFrame:
    rows = [(*s, *(DEFAULT_REQUEST | REQUEST.get(s[0], {})).values()) for s in _S]
    df = spark.createDataFrame(rows, SOURCES_SCHEMA)
    return df.where("active") if active_only else df


def newest_first_labels() -> list[str]:
    """Sources whose request asks for the newest articles first (SP6)."""
    return [s[0] for s in _S if (DEFAULT_REQUEST | REQUEST.get(s[0], {}))["sort"] in NEWEST_FIRST]


def request_windows() -> dict[str, int | None]:
    """Days each source's daily request reaches back (SP1); None: no limit."""
    return {s[0]: (DEFAULT_REQUEST | REQUEST.get(s[0], {}))["window_days"] for s in _S}
