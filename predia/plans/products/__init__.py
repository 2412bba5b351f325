"""The seven denormalised products and how they are published."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from predia.fixed_values import CUSTOMER_TABLES
from predia.plans.products.leads import leads
from predia.plans.products.offers import property_offers
from predia.plans.products.profiles import customer_profile
from predia.plans.products.properties import properties_and_projects
from predia.plans.products.services import service_catalog, services_per_user
from predia.plans.products.users import app_users
from predia.plans.together import run_together
from predia.sources.config import JobConfig
from predia.sources.keyed_table import KeyedTable


class Product(NamedTuple):
    """A product: its rows from curated tables, its key, and the tables it reads."""

    build: Callable[..., DataFrame]
    key: str
    reads: tuple[str, ...]


PRODUCTS: dict[str, Product] = {
    "properties_and_projects": Product(properties_and_projects, "id_publication", (
        "ciudad", "departamento", "localidad", "barrio", "s_estrato", "usuario", "s_tipo_inmueble",
        "s_estado_proyecto", "detalle_caracteristicas_inmueble", "definicion_caracteristicas", "inmuebles_tipo",
        "proyectos", "inmueble")),
    "app_users": Product(app_users, "id_app_identification_number", (
        "usuario", "tipo_documento", "tipo_usuario", "rol", "ciudad", "departamento", "habeas_data")),
    "leads": Product(leads, "id_app_identification_number", (
        "contacto", "inmueble", "usuario", "contacto_proyecto", "inmuebles_tipo", "proyectos")),
    "service_catalog": Product(service_catalog, "id_service", ("plan", "producto_carrito")),
    "services_per_user": Product(services_per_user, "id_service_purchased", (
        "plan", "producto_carrito", "portafolio_productos_usuario", "estado_portafolio_producto")),
    "customer_profile": Product(customer_profile, "id_profile", (
        "tipo_documento", "cliente", "correo_contacto_cliente", "perfilamiento_cliente")),
    "property_offers": Product(property_offers, "id_offer", ("ofertas", "ofertas_tipos_rechazo", "inmueble")),
}


def publish(name: str, tables: Mapping[str, DataFrame], target: KeyedTable, as_of=None, replace: bool = False,
            **kwargs) -> str | None:
    """Build a product and write it by key.

    Rows whose source is gone stay, unless ``replace`` makes the new rows the whole product.
    """
    rows = PRODUCTS[name].build(tables, as_of, **kwargs)
    return target.overwrite(rows) if replace else target.upsert(rows, ["dt_product_hudi_date_time"])


def refresh(
    spark: SparkSession, job: JobConfig, marketplace_schema: str, customer_schema: str, names=tuple(PRODUCTS),
    as_of=None, replace: bool = False, parallel: int = 4,
) -> dict[str, str | None]:
    """Build products from the curated tables of a job and publish them beside these, under the schema ``products``."""
    def schema_of(table: str) -> str:
        return customer_schema if table in CUSTOMER_TABLES else marketplace_schema

    def one(name: str) -> str | None:
        tables = {t: KeyedTable(spark, job.target(schema_of(t), t)).snapshot() for t in PRODUCTS[name].reads}
        target = KeyedTable(spark, job.target("products", name), PRODUCTS[name].key,
                            catalog_name=job.catalog_name("products", name))
        return publish(name, tables, target, as_of, replace)

    return run_together(spark, {name: lambda name=name: one(name) for name in names}, parallel)
