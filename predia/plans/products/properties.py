"""Publications: used properties, and the building classes of new projects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predia.fixed_values import (
    ATTRIBUTE_COLUMNS, COMMERCIAL_PROJECT_PATH, HOUSING_PROJECT_PATH, HOUSING_TYPES, NO, PET_FLAG, PROJECT_KIND,
    PROJECT_SITE, PROJECT_STATUS, PROPERTIES_REQUIRED, PROPERTIES_SCHEMA, PROPERTY_IN_PROJECT_PATH, PROPERTY_KIND,
    PROPERTY_PATH, PROPERTY_SITE, PROPERTY_STATUS, VIGILANCE_CODES, ZERO_COUNTS,
)
from predia.functions import (
    clock, days_since, decode, first_positive, fold_accents, is_known_flag, one_of_flag, or_constant, parse_time,
    part_of, price_per_unit, slug, to_area, to_decimal, to_float, to_int, yes_no,
)
from predia.operators.cleaning import fill_zero
from predia.operators.enrich import lookup, pivot_attributes, union_branches
from predia.plans.products.common import city_columns, finish

SITE_URL = "https://www.example.com"

# Columns of a property that reach a publication under another name, by how they are read.
PROPERTY_TEXTS = {
    "direccion": "ds_address",
    "latitud": "ds_latitude",
    "longitud": "ds_longitude",
    "matricula_inmobiliaria": "ds_property_real_state_registration_number",
}
PROPERTY_FLAGS = {
    "cuarto_servicio": "fl_has_service_room",
    "bano_servicio": "fl_has_service_bathroom",
    "zona_lavanderia": "fl_has_laundry_area",
    "aire_acondicionado": "fl_has_air_conditioner",
    "recepcion": "fl_has_reception",
    "sede_social": "fl_has_social_room",
    "salon_comunal": "fl_has_communal_living",
    "zona_infantil": "fl_has_children_zone",
    "zonas_verdes": "fl_has_green_zones",
    "piscina_comunal": "fl_has_pool",
    "gimnasio": "fl_has_gym",
    "enoferta": "fl_is_property_offer",
}
PROPERTY_PRICES = {
    "precio_venta": "nm_property_selling_price",
    "canon_arrendamiento": "nm_property_monthly_rent_payment",
    "valor_administracion": "nm_property_monthly_administration_fee",
}
PROPERTY_COUNTS = {
    "num_parqueaderos": "nm_parking_number",
    "num_parqueaderos_visitantes": "nm_visitors_parking_number",
    "num_habitaciones": "nm_bedroom_number",
    "num_banos": "nm_bathroom_number",
    "antiguedad": "nm_property_age",
    "num_balcones": "nm_balcony_number",
    "num_terraza": "nm_terrace_number",
    "num_depositos": "nm_storage_room_number",
    "num_ascensores": "nm_elevator_number",
}
PROPERTY_DATES = {
    "fecha_creacion": "dt_creation_date",
    "fecha_modificacion": "dt_modification_date",
    "start_publicacion": "dt_property_inception_date",
    "end_publicacion": "dt_property_expiration_date",
    "fecha_eliminacion": "dt_property_deletion_date",
}

# How the attributes of a building class are read. Flags that are no attribute are no.
ATTRIBUTE_FLAGS = (
    "fl_has_laundry_area", "fl_has_pool", "fl_has_service_room", "fl_has_service_bathroom", "fl_has_air_conditioner",
)
ATTRIBUTE_READERS = {
    **dict.fromkeys(("nm_property_selling_price", "nm_property_monthly_administration_fee"), to_decimal),
    **dict.fromkeys(("nm_built_area", "nm_private_area"), to_float),
    **dict.fromkeys(ZERO_COUNTS, to_int),
    **dict.fromkeys(ATTRIBUTE_FLAGS, yes_no),
    "fl_is_pet_allowed": lambda text: decode(text, *PET_FLAG),
    "fl_has_home_appliances": is_known_flag,
}

PLACE_KEYS = ("estrato", "id_ciudad", "id_localidad", "id_barrio", "id_tipo_inmueble")
PLACE_COLUMNS = (
    "ds_property_type", "cd_state_dane_code", "ds_state_name", "cd_city_dane_code", "ds_city_name", "ds_neighborhood",
    "ds_district_division", "cd_neighborhood_economic_level",
)
OWNER_COLUMNS = ("id_publication_owner_app_identification_number", "ds_publication_owner_email")


def _with_places(df: DataFrame, tables: Mapping[str, DataFrame], state_key: str) -> DataFrame:
    """The six small lookups: economic level, city, state, district, neighbourhood, property type.

    Parts of a page address are made here, once per place rather than once per publication.
    """
    named = F.initcap("valor")
    df = lookup(df, tables["s_estrato"], "estrato", "id", {"cd_neighborhood_economic_level": "valor"})
    df = lookup(df, city_columns(tables["ciudad"]), "id_ciudad", "id", {
        **{c: c for c in ("ds_city_name", "cd_city_dane_code", "cd_state_dane_code")},
        "city_part": fold_accents(slug(F.col("ds_city_name"))),
    })
    df = lookup(df, tables["departamento"], state_key, "id", {"ds_state_name": "valor"})
    df = lookup(df, tables["localidad"], "id_localidad", "id", {"ds_district_division": named})
    df = lookup(df, tables["barrio"], "id_barrio", "id", {
        "ds_neighborhood": named,
        "neighborhood_part": fold_accents(slug(named)),
        "neighborhood_untrimmed": fold_accents(slug(named, trimmed=False)),
    })
    return lookup(df, tables["s_tipo_inmueble"], "id_tipo_inmueble", "id", {
        "ds_property_type": "valor", "type_part": fold_accents(F.lower("valor")),
    })


def _with_owner(df: DataFrame, users: DataFrame) -> DataFrame:
    return lookup(df, users, "id_usuario", "id", {
        "id_publication_owner_app_identification_number": F.col("id").cast("string"),
        "ds_publication_owner_email": F.lower("correo_electronico"),
        "owner_part": fold_accents(slug(F.col("nombre"))),
    }, "inner")


def _page(site: str, *parts: Column | str) -> Column:
    """A page address from parts without accents, or the site's home page when any part is missing."""
    return or_constant(F.concat(F.lit(site), *[F.lit(p) if isinstance(p, str) else p for p in parts]), f"{site}/")


def _used_properties(tables: Mapping[str, DataFrame], site: str) -> DataFrame:
    """Properties with a known owner. What needs no lookup is made first, in one step over the source."""
    areas = ("area_construida", "area_bodega", "area_lote", "area_oficina")
    measured = tables["inmueble"].withColumns({
        **{name: to_area(F.col(name)) for name in areas},
        "store": decode(F.col("id_tipo_transaccion"), *PROPERTY_SITE),
    }).withColumn("built", first_positive(*[F.col(name) for name in areas]))
    properties = measured.select(
        F.col("codigo").alias("id_publication"),
        decode(F.col("activo"), *PROPERTY_STATUS).alias("ds_publication_status"),
        F.lit(PROPERTY_KIND).alias("ds_publication_type"),
        F.col("store").alias("ds_publication_site_store"),
        price_per_unit(F.col("precio_venta"), F.col("built")).alias("nm_square_meter_price"),
        to_float(F.col("built")).alias("nm_built_area"),
        to_float(to_area(F.col("area_privada"))).alias("nm_private_area"),
        *[to_decimal(F.col(source)).alias(name) for source, name in PROPERTY_PRICES.items()],
        *[F.abs(to_int(F.col(source))).alias(name) for source, name in PROPERTY_COUNTS.items()],
        *[F.col(source).cast("string").alias(name) for source, name in PROPERTY_TEXTS.items()],
        *[yes_no(F.col(source)).alias(name) for source, name in PROPERTY_FLAGS.items()],
        *[parse_time(F.col(source)).alias(name) for source, name in PROPERTY_DATES.items()],
        decode(F.col("permite_mascotas"), *PET_FLAG).alias("fl_is_pet_allowed"),
        is_known_flag(F.col("electrodomesticos")).alias("fl_has_home_appliances"),
        one_of_flag(F.col("vigilancia"), VIGILANCE_CODES).alias("fl_has_vigilance"),
        slug(F.col("store")).alias("store_part"),
        fold_accents(slug(F.col("nombre_proyecto"))).alias("project_part"),
        F.col("id").cast("string").alias("number_part"),
        (F.col("proyecto").cast("string") == "0").alias("is_single"),
        *PLACE_KEYS, "id_depto", "id_usuario",
    )
    placed = _with_owner(_with_places(properties, tables, "id_depto"), tables["usuario"])
    place = (F.col("city_part"), "-", F.col("number_part"))
    page = F.when(F.col("is_single"), _page(
        site, PROPERTY_PATH, F.col("type_part"), "-en-", F.col("store_part"), "-en-",
        F.col("neighborhood_untrimmed"), "-", *place,
    )).otherwise(_page(
        site, PROPERTY_IN_PROJECT_PATH, F.col("project_part"), "-en-", F.col("neighborhood_part"), "-", *place,
    ))
    made = [c for c in properties.columns if c.startswith(("id_publication", "ds_", "nm_", "fl_", "dt_"))]
    return placed.select(*made, *PLACE_COLUMNS, *OWNER_COLUMNS, page.alias("tx_url"))


def _projects(tables: Mapping[str, DataFrame], site: str) -> DataFrame:
    """Projects with a known status and owner."""
    projects = lookup(tables["proyectos"], tables["s_estado_proyecto"], "id_estado_proyecto", "id",
                      {"ds_property_project_status": "valor"}, "inner")
    projects = _with_owner(_with_places(projects, tables, "id_departamento"), tables["usuario"])
    name = F.initcap("nombre_proyecto")
    parts = (F.col("owner_part"), "-", fold_accents(slug(name)), "-", F.col("city_part"), "-",
             F.col("id_proyecto").cast("string"))
    page = F.when(F.col("ds_property_type").isin(*HOUSING_TYPES), _page(site, HOUSING_PROJECT_PATH, *parts))
    return projects.select(
        "id_proyecto", *PLACE_COLUMNS, *OWNER_COLUMNS, "ds_property_project_status",
        F.col("codigo_proyecto").cast("string").alias("id_property_project"),
        name.alias("ds_property_project_name"),
        decode(F.col("estado"), *PROJECT_STATUS).alias("ds_publication_status"),
        F.col("direccion").alias("ds_address"),
        F.col("latitud").cast("string").alias("ds_latitude"),
        F.col("longitud").cast("string").alias("ds_longitude"),
        parse_time(F.col("fecha_creacion")).alias("dt_creation_date"),
        parse_time(F.col("fecha_modificacion")).alias("dt_modification_date"),
        parse_time(F.col("fecha_entrega")).alias("dt_property_project_delivery_date"),
        page.otherwise(_page(site, COMMERCIAL_PROJECT_PATH, *parts)).alias("tx_url"),
    )


def _project_classes(tables: Mapping[str, DataFrame], site: str) -> DataFrame:
    """Building classes that have attributes, each with its project.

    The join starts at the classes, the many side, and looks up what is unique: attributes, then the project.
    """
    attributes = pivot_attributes(
        tables["detalle_caracteristicas_inmueble"], tables["definicion_caracteristicas"], list(ATTRIBUTE_COLUMNS),
        "id_inmueble", "id_caracteristica", "valor", "alias", "id_detalle_inmueble",
    )
    classes = tables["inmuebles_tipo"].select(
        "id_inmueble_tipo", "id_proyecto",
        F.col("codigo_tipo_propiedad").alias("id_property_project_building_class"),
        F.col("nombre").alias("ds_property_project_building_class_name"),
        decode(F.col("estado"), *PROJECT_STATUS).alias("ds_property_project_building_class_status"),
    )
    classes = lookup(classes, attributes, "id_inmueble_tipo", "id_inmueble", {
        **{name: ATTRIBUTE_READERS[name](F.col(alias)) for alias, name in ATTRIBUTE_COLUMNS.items()},
        "nm_square_meter_price": price_per_unit(F.col("sellingPrice"), F.col("builtArea")),
    }, "inner")
    projects = _projects(tables, site)
    rows = lookup(classes, projects, "id_proyecto", "id_proyecto", {c: c for c in projects.columns[1:]}, "inner")
    class_code = part_of(F.col("id_property_project_building_class"), 1)
    return rows.withColumns({
        "id_publication": F.concat_ws("-", F.col("id_property_project"), class_code),
        "ds_publication_type": F.lit(PROJECT_KIND),
        "ds_publication_site_store": F.lit(PROJECT_SITE),
        "fl_has_vigilance": F.lit(NO),
        **{c: F.lit(NO) for c in PROPERTY_FLAGS.values() if c not in ATTRIBUTE_FLAGS},
    }).drop("id_inmueble_tipo", "id_proyecto")


def properties_and_projects(tables: Mapping[str, DataFrame], as_of=None, site: str = SITE_URL) -> DataFrame:
    """One row per publication, used or new. What a branch does not have is null, and for a count zero."""
    now = clock(as_of)
    rows = union_branches(_used_properties(tables, site), _project_classes(tables, site))
    rows = rows.withColumn("nm_publication_days_since_posted", days_since(now, F.col("dt_creation_date")))
    rows = fill_zero(rows, ZERO_COUNTS)
    return finish(rows, "id_publication", PROPERTIES_REQUIRED, now, schema=PROPERTIES_SCHEMA)
