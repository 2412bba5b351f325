"""Four reporting marts over the products.

The columns are given; the formulas are ours and stated here. Stock is the base: every publication of the mart's
kind appears once per lead, or once without leads. Unqualified columns that several products share come from
the owner (``app_users``), in the supply and demand mart from the publication.

* ``Lead``, ``CreationLeadDate``: when the lead was created. ``dt_creation_date[leads]``: the same as yyyymmdd number.
* ``MonoLead``: one text per person behind leads: e-mail, else cell phone, else the lead's number.
* ``Company Name``: the owner's name unless the owner is a natural person.
* ``Plan``, ``ds_name[service_catalog]``: the owner's service that ends last (for ``Plan`` among plans only).
* ``DateUser``: when the owner registered. ``CreationStockDate``: when the publication was created.
* ``ds_country``: a constant.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predia.fixed_values import (
    AGENCIES_MART, BUILDERS_MART, COUNTRY, GEOGRAPHIC_ROLES, PERSON_CLASS, PERSONS_MART, PLAN_KIND, PROJECT_KIND,
    PROPERTY_KIND, SUPPLY_DEMAND_MART,
)
from predia.operators.cleaning import quoted
from predia.operators.enrich import lookup
from predia.operators.hot_keys import left_fan_out
from predia.operators.latest import one_per_key

OWNER = "id_publication_owner_app_identification_number"
USER = "id_app_identification_number"
BUYER = "id_user_app_identification_number"


def shape_dataset(
    df: DataFrame, casts: Mapping[str, str] | None = None, renames: Mapping[str, str] | None = None,
    computed: Mapping[str, Column] | None = None, columns: Iterable[str] | None = None,
    roles: Mapping[str, str] | None = None,
) -> DataFrame:
    """The preparation steps of a dataset in their order: cast, rename, compute, project, tag.

    A geographic role becomes column metadata.
    """
    df = df.withColumns({c: quoted(c).try_cast(t) for c, t in (casts or {}).items()})
    df = df.withColumnsRenamed(dict(renames or {})).withColumns(dict(computed or {}))
    roles = roles or {}
    return df.select(*[
        quoted(c).alias(c, metadata={"geographic_role": roles[c]}) if c in roles else quoted(c)
        for c in (columns or df.columns)
    ])


def _with_owner(stock: DataFrame, users: DataFrame, how: str = "inner") -> DataFrame:
    return lookup(stock, users, OWNER, USER, {
        "owner_status": "ds_status", "owner_type": "ds_type", "owner_name": "ds_name", "owner_city": "ds_city_name",
        "owner_state": "ds_state_name", "owner_since": "dt_creation_date", "owner": USER,
    }, how)


def _with_leads(stock: DataFrame, leads: DataFrame) -> DataFrame:
    """A row per publication and lead. One publication may draw a large share of all leads."""
    created = F.col("dt_creation_date")
    wanted = leads.select(
        F.col("id_publication").alias("lead_publication"),
        F.col(USER).alias("lead_number"),
        F.col(BUYER).alias("lead_owner"),
        created.alias("lead_created"),
        F.date_format(created, "yyyyMMdd").cast("int").alias("lead_day"),
        F.coalesce("ds_email", "ds_cellphone_number", USER).alias("lead_person"),
    )
    return left_fan_out(stock, wanted, "id_publication", "lead_publication")


def _last_service(products: Mapping[str, DataFrame], kind: str | None = None) -> DataFrame:
    """Per buyer the purchase that ends last, with the name of its service."""
    bought = products["services_per_user"].select(BUYER, "dt_expiration_date", "id_service_purchased", "id_service",
                                                  "ds_service_type")
    if kind is not None:
        bought = bought.where(F.col("ds_service_type") == kind)
    last = one_per_key(bought, [BUYER], ["dt_expiration_date"])
    return lookup(last, products["service_catalog"], "id_service", "id_service", {"service_name": "ds_name"})


def builders_mart(products: Mapping[str, DataFrame]) -> DataFrame:
    """Projects and their leads, with the building company."""
    stock = products["properties_and_projects"].where(F.col("ds_publication_type") == PROJECT_KIND).select(
        "id_publication", OWNER, "nm_parking_number", "nm_bathroom_number", "nm_property_selling_price",
        "ds_property_project_status", "nm_built_area", "nm_bedroom_number",
        F.col("ds_city_name").alias("ds_city_name[properties_and_projects]"), "ds_property_project_name",
    )
    rows = _with_leads(_with_owner(stock, products["app_users"], "left"), products["leads"])
    return shape_dataset(
        rows,
        renames={
            "lead_created": "Lead", "owner_status": "ds_status", "lead_publication": "id_publication[leads]",
            "owner_type": "ds_type", "owner_name": "ds_name", "lead_person": "MonoLead",
        },
        computed={"Company Name": F.when(F.col("ds_type") != PERSON_CLASS, F.col("ds_name"))},
        columns=BUILDERS_MART,
    )


def agencies_mart(products: Mapping[str, DataFrame]) -> DataFrame:
    """Used properties of owners that are not natural persons, their leads and the owner's plan."""
    stock = products["properties_and_projects"].where(F.col("ds_publication_type") == PROPERTY_KIND).select(
        "id_publication", OWNER, F.col("ds_city_name").alias("ds_city_name[properties_and_projects]"),
    )
    owners = products["app_users"].where(F.col("ds_type") != PERSON_CLASS)
    stock = lookup(_with_owner(stock, owners), _last_service(products, PLAN_KIND), OWNER, BUYER,
                   {"Plan": "service_name"})
    return shape_dataset(
        _with_leads(stock, products["leads"]),
        renames={
            "owner_state": "ds_state_name", "lead_day": "dt_creation_date[leads]", "owner_city": "ds_city_name",
            "owner_status": "ds_status", "owner_name": "ds_name", "owner_since": "DateUser",
        },
        columns=AGENCIES_MART,
        roles=GEOGRAPHIC_ROLES,
    )


def persons_mart(products: Mapping[str, DataFrame]) -> DataFrame:
    """Used properties of natural persons and the service each person bought."""
    stock = products["properties_and_projects"].where(F.col("ds_publication_type") == PROPERTY_KIND).select(
        "ds_property_type", "ds_publication_site_store", "ds_publication_status", OWNER,
        F.col("ds_city_name").alias("ds_city_name[properties_and_projects]"),
    )
    owners = products["app_users"].where(F.col("ds_type") == PERSON_CLASS)
    rows = lookup(_with_owner(stock, owners), _last_service(products), OWNER, BUYER,
                  {"ds_name[service_catalog]": "service_name", BUYER: BUYER})
    return shape_dataset(
        rows, renames={"owner_type": "ds_type", "owner": USER, "owner_since": "DateUser"}, columns=PERSONS_MART
    )


def supply_demand_mart(products: Mapping[str, DataFrame]) -> DataFrame:
    """Every publication and its leads, with the features that are asked for."""
    lead_columns = {"CreationLeadDate", "dt_creation_date[leads]", USER, BUYER}
    own = [c for c in SUPPLY_DEMAND_MART if c not in lead_columns | {"ds_country", "CreationStockDate"}]
    stock = products["properties_and_projects"].select(*own, F.col("dt_creation_date").alias("CreationStockDate"))
    return shape_dataset(
        _with_leads(stock, products["leads"]),
        renames={
            "lead_created": "CreationLeadDate", "lead_day": "dt_creation_date[leads]", "lead_number": USER,
            "lead_owner": BUYER,
        },
        computed={"ds_country": F.lit(COUNTRY)},
        columns=SUPPLY_DEMAND_MART,
        roles=GEOGRAPHIC_ROLES,
    )


MARTS = {
    "builders": builders_mart,
    "agencies": agencies_mart,
    "persons": persons_mart,
    "supply_demand": supply_demand_mart,
}
