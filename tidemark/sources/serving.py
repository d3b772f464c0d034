"""Publishing gold: full copies, and the secured serving views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import GOLD_TABLES
from tidemark.operators.secure import MASKS, PROTECTED_BAND, add_investigator
from tidemark.session import concurrently
from tidemark.sources.layers import LayerStore

LAYER = "serving"
INVESTIGATORS = "RiskInvestigatorPrincipal"
COPIED = ("DimCustomer", "DimDevice", "AggCustomerRiskProfile")


def publish_tables(store: LayerStore, layer: str = "published") -> DataFrame:
    """Publish a copy of every gold object in order, each a full replacement.

    The copies are made side by side and become visible in publishing order, so
    a repeated run cannot double a fact.  Returns ``(execution_order,
    object_name, row_count)``.
    """
    sources = {name: store.read("gold", name) for name in GOLD_TABLES}
    copies = concurrently({name: lambda name=name, df=df: store.stage(df, layer, name)
                           for name, df in sources.items()})
    counts = []
    for order, name in enumerate(GOLD_TABLES, start=1):
        store.switch(layer, name, sources[name].schema, copies[name])
        counts.append((order, name, store.count(layer, name)))
    return store.spark.createDataFrame(
        counts, "execution_order int, object_name string, row_count bigint")


def refresh_serving(store: LayerStore) -> int:
    """Replace the serving copies and views; returns the rows copied.

    The three protected objects are copied and shown through views that carry
    their mask or row filter; a view is dropped before its copy is replaced and
    comes back with its protection, so there is no unprotected moment.  The
    other six views read gold in place.
    """
    if not store.exists(LAYER, INVESTIGATORS):
        empty = store.spark.createDataFrame([], "PrincipalName string")
        store.replace(empty, LAYER, INVESTIGATORS)
    sources = {name: store.read("gold", name) for name in COPIED}
    copies = concurrently({name: lambda name=name, df=df: store.stage(df, LAYER, f"_base_{name}")
                           for name, df in sources.items()})
    rows = 0
    for name in COPIED:
        store.spark.sql(f"DROP VIEW IF EXISTS {store.name(LAYER, name)}")
        store.switch(LAYER, f"_base_{name}", sources[name].schema, copies[name])
        rows += store.count(LAYER, f"_base_{name}")
    for name in GOLD_TABLES:
        store.spark.sql(
            f"CREATE OR REPLACE VIEW {store.name(LAYER, name)} AS {_view_text(store, name)}")
    return rows


def _view_text(store: LayerStore, name: str) -> str:
    if name not in COPIED:
        return f"SELECT * FROM {store.name('gold', name)}"
    base = store.name(LAYER, f"_base_{name}")
    if name in MASKS:
        column, prefix, padding, suffix = MASKS[name]
        shown = (f"CASE WHEN length({column}) >= {prefix + suffix} THEN "
                 f"concat(substring({column}, 1, {prefix}), '{padding}', right({column}, {suffix}))"
                 f" WHEN {column} IS NOT NULL THEN '{padding}' END AS {column}")
        columns = ", ".join(shown if c == column else f"`{c}`"
                            for c in store.spark.table(base).columns)
        return f"SELECT {columns} FROM {base}"
    return (f"SELECT * FROM {base} WHERE CustomerRiskBand <> '{PROTECTED_BAND}' OR EXISTS "
            f"(SELECT 1 FROM {store.name(LAYER, INVESTIGATORS)} WHERE PrincipalName = "
            "current_user())")


def grant_investigator(store: LayerStore, principal: str) -> None:
    store.replace(add_investigator(store.read(LAYER, INVESTIGATORS), principal),
                  LAYER, INVESTIGATORS)


def view_counts(store: LayerStore) -> DataFrame:
    """``(view_name, row_count)`` as the session user sees the nine views."""
    parts = [store.read(LAYER, name).agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("view_name"), "row_count") for name in GOLD_TABLES]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts
