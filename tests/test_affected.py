"""Refresh by affected keys: which keys a change reaches, and that the rest is left alone."""

import pytest
from pyspark.sql import functions as F

from predia.plans.affected import LINEAGE, affected_keys, lineage_gaps, needed_rows, refresh_affected
from predia.plans.products import PRODUCTS, publish
from predia.session import scratch_path
from predia.sources.keyed_table import KeyedTable
from predia.workload.standins import standins

FOLDER = "/root/testdata/sf0.001"
AS_OF = "2024-06-30 12:00:00"


@pytest.mark.parametrize("name", LINEAGE)
def test_every_source_reaches_its_product(name):
    assert lineage_gaps(name) == []


def changed_source(spark, path, rows, key, change, removed=None):
    """A keyed table with ``rows`` after a commit that changed or removed some."""
    table = KeyedTable(spark, path, key)
    table.overwrite(rows)
    since = table.last_commit()
    if removed is not None:
        table.delete(removed)
    if change is not None:
        table.upsert(change)
    return table, since


CASES = [
    ("properties_and_projects", "usuario", "id", "correo_electronico"),
    ("properties_and_projects", "s_estado_proyecto", "id", "valor"),
    ("properties_and_projects", "definicion_caracteristicas", "id_caracteristica", "alias"),
    ("app_users", "rol", "id", "valor"),
    ("service_catalog", "plan", "id", "title"),
    ("services_per_user", "producto_carrito", "id", "codigo"),
    ("customer_profile", "cliente", "id", "nombre"),
    ("customer_profile", "correo_contacto_cliente", "id", "correo_electronico"),
    ("property_offers", "inmueble", "id", "codigo"),
]


@pytest.mark.parametrize("name,source,key,column", CASES)
def test_equals_the_full_rebuild(spark, rows, name, source, key, column):
    """Some rows of one source change, others go; the product must be what a full rebuild gives."""
    path, product = scratch_path(spark, "affected-test"), PRODUCTS[name]
    tables = standins(spark, FOLDER, product.reads)
    numbered = F.pmod(F.xxhash64(F.col(key)), F.lit(7))
    change = tables[source].where(numbered == 1).withColumn(column, F.concat(F.lit("1"), F.col(column)))
    table, since = changed_source(spark, f"{path}/{source}", tables[source], key, None)
    target = KeyedTable(spark, f"{path}/product", product.key)
    publish(name, tables, target, AS_OF, replace=True)
    before = target.last_commit()
    table.merge(change, tables[source].where(numbered == 2))
    gone = refresh_affected(spark, name, {**tables, source: table}, {source: since}, target, AS_OF)
    full = product.build({**tables, source: table.snapshot()}, AS_OF)
    assert rows(target.snapshot().select(*full.columns)) == rows(full)
    kept = target.snapshot().select(product.key)
    assert gone.join(kept, product.key).count() == 0
    assert target.images(before).where("_image = 'before'").count() <= target.snapshot().count() + gone.count()


def test_only_touched_rows_are_built(spark):
    """One user changes: the homes and projects of that user are all that is joined again."""
    product = PRODUCTS["properties_and_projects"]
    tables = standins(spark, FOLDER, product.reads)
    user = tables["inmueble"].select("id_usuario").join(
        tables["usuario"].select(F.col("id").alias("id_usuario")), "id_usuario").first()["id_usuario"]
    images = {"usuario": tables["usuario"].where(F.col("id") == user)}
    lineage = LINEAGE["properties_and_projects"]
    keys = affected_keys(lineage, tables, images)
    homes = tables["inmueble"].where(F.col("id_usuario") == user)
    assert 0 < homes.count() <= keys.count() <= homes.count() + 2
    cut = needed_rows(lineage, tables, keys, scratch_path(spark, "needed"))
    assert cut["inmueble"].count() == homes.where("codigo IS NOT NULL").count()
    assert cut["usuario"].count() == 1 and cut["proyectos"].count() <= 1
    assert cut["detalle_caracteristicas_inmueble"].count() < 100
    # What is joined again reads the few stored rows of the base, not the table it was cut from.
    plan = product.build(cut, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderkey") == 0


def test_nothing_changed(spark, rows):
    path, product = scratch_path(spark, "unchanged"), PRODUCTS["service_catalog"]
    tables = standins(spark, FOLDER, product.reads)
    table, since = changed_source(spark, f"{path}/plan", tables["plan"], "id", None)
    target = KeyedTable(spark, f"{path}/product", product.key)
    publish("service_catalog", tables, target, AS_OF)
    commit = target.last_commit()
    gone = refresh_affected(spark, "service_catalog", {**tables, "plan": table}, {"plan": since}, target, AS_OF)
    assert gone.count() == 0 and target.last_commit() == commit
