"""Oracle SQL (DuckDB) for every registered query key.

``ORACLE[key]`` is a complete statement over the pre-registered driver
views.  Double columns are rounded to 6 digits, like the Spark side.
"""

from __future__ import annotations

from pitchlake.oracle import model_sql  # noqa: F401  (registers the model CTEs)
from pitchlake.oracle.bindings_sql import sround, with_ctes

ORACLE: dict[str, str] = {}


def oracle(key: str, body: str, *ctes: str, doubles: tuple[str, ...] = (),
           extra: list[tuple[str, str]] | None = None) -> None:
    if doubles:
        rep = ", ".join(f"{sround(c, 6)} AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({rep}) FROM ({body}) _q"
    ORACLE[key] = with_ctes(body, *ctes, extra=extra)


def load_all() -> dict[str, str]:
    from pitchlake.oracle import (q_core_sql, q_io_sql, q_meta_sql, q_ml_sql, q_more_sql, q_ops_sql,  # noqa: F401
                                  q_stream_sql, q_tests_sql)
    from pitchlake.oracle import q_bronze_sql  # noqa: F401  (on top of q_io_sql)
    return ORACLE
