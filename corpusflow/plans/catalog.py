"""Driver-facing queries over the landed stand-in tables, each with its SQL oracle.

Each entry maps a SURVEY section-2 operator onto the driver tables (see
FIXTURES.md section 4) and runs over the whole tables. The SQL strings are
written independently of the Spark code (window functions where the Spark
side uses aggregate-and-join, etc.) so the comparison is a real check.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# SQL building blocks for the oracle side (DuckDB / RE2 spelling). The patterns.

WS_SQL = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def sql_remove_tags(expr: str) -> str:
    clock = r"\b[0-9]{1,2}\.[0-9]{2}[apmAPM]+" + WS_SQL + r"+[GMTgmt]+\b"
    boiler = (r"© [0-9]+ BBC\. The BBC is not responsible for the content of external "
              r"sites\. Read about our approach to external linking\.")
    s = f"regexp_replace({expr}, '<.*?>', '', 'g')"
    s = f"regexp_replace({s}, '{clock}', '', 'g')"
    s = f"regexp_replace({s}, '{WS_SQL}+', ' ', 'g')"
    s = f"regexp_replace({s}, '{boiler}', '', 'g')"
    return s


def sql_host(expr: str) -> str:
    return f"regexp_extract({expr}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)"


def sql_word_tokens(expr: str) -> str:
    return f"regexp_extract_all(coalesce({expr}, ''), ' *[^ ]+ *')"


def load_all():
    """Import every module that registers queries."""
    from . import queries_gates, queries_monitor, queries_order, queries_text, queries_vectors  # noqa: F401
    return QUERIES, ORACLES
