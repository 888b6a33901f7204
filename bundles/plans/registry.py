"""Query registry: every operator of the inventory as (Spark builder, oracle SQL).

A query is a function ``(spark, sf_dir) -> DataFrame`` reading the driver
tables (or views over them).  Its oracle is DuckDB SQL over the same tables,
or ``None`` where the operator has no SQL form (model fitting, file I/O whose
output is checked by row count only).
"""

from __future__ import annotations

from collections.abc import Callable

from ..fixtures import COLLECTIONS_SQL, PRODUCTS_SQL, RAW_META_SQL, RAW_REVIEWS_SQL, REVIEWS_SQL

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

FX_CTES = (f"fx_products as ({PRODUCTS_SQL}),\n fx_reviews as ({REVIEWS_SQL}),\n"
           f" fx_collections as ({COLLECTIONS_SQL}),\n raw_reviews as ({RAW_REVIEWS_SQL}),\n"
           f" raw_meta as ({RAW_META_SQL})")


def with_fx(body: str) -> str:
    """Prefix the fixture views as CTEs.  ``body`` may start with more CTEs
    (``, name as (...)``) followed by the final select."""
    body = body.strip()
    if body[:15].lower() == "with recursive ":
        return f"with recursive {FX_CTES}, {body[15:]}"
    if body[:5].lower() == "with ":
        body = ", " + body[5:]
    if body.startswith(","):
        return f"with {FX_CTES}{body}"
    return f"with {FX_CTES}\n{body}"


def query(key: str, sql: str | None = None, fx: bool = True):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_fx(sql) if fx else sql
        return fn
    return deco


def load_all():
    """Import every query module so that the decorators run."""
    from . import q_agg, q_cascade, q_clean, q_core, q_io, q_mining, q_ml, q_recommend, q_text  # noqa: F401
    return QUERIES, ORACLE
