"""Registry of named queries: Spark builder plus the DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docweave.session import ensure_checkpoint_dir, load_table, ship_package

_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = (run, sql)
        return fn
    return deco


class Tables:
    """Lazy table handles for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load_table(self.spark, self.sf_dir, name)


def _load_all():
    from docweave.plans import (q_text, q_vectors, q_store, q_profile, q_html,  # noqa: F401
                                q_graph, q_prompts, q_eval, q_stream)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
