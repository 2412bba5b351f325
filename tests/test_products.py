"""Products and marts on hand-made rows; expected values are written by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from predia.fixed_values import (
    AGENCIES_MART, BUILDERS_MART, LEADS_SCHEMA, PERSONS_MART, PROPERTIES_SCHEMA, SUPPLY_DEMAND_MART, USERS_SCHEMA,
)
from predia.operators.schema import parse_schema
from predia.plans.marts import MARTS
from predia.fixed_values import CUSTOMER_TABLES
from predia.plans.curated import load_all
from predia.plans.products import PRODUCTS, publish, refresh
from predia.session import scratch_path
from predia.sources.config import JobConfig
from predia.sources.keyed_table import KeyedTable
from predia.workload.storage_queries import feed_files

AS_OF = "2024-06-30 12:00:00"
DAY = dt.datetime(2024, 6, 1)

INMUEBLE = """id int, id_depto int, id_ciudad int, id_localidad int, id_barrio int, id_tipo_inmueble int,
    id_usuario int, estrato int, id_tipo_transaccion int, codigo string, direccion string,
    matricula_inmobiliaria string, nombre_proyecto string, latitud string, longitud string, precio_venta decimal(18,2),
    canon_arrendamiento decimal(18,2), valor_administracion decimal(18,2), num_parqueaderos int, num_habitaciones int,
    num_banos int, antiguedad int, num_balcones int, num_terraza int, num_depositos int, num_ascensores int,
    num_parqueaderos_visitantes int, area_bodega double, area_oficina double, area_lote double, area_construida double,
    area_privada double, cuarto_servicio int, bano_servicio int, zona_lavanderia int, aire_acondicionado int,
    recepcion int, sede_social int, salon_comunal int, zona_infantil int, zonas_verdes int, piscina_comunal int,
    gimnasio int, permite_mascotas int, enoferta int, electrodomesticos string, vigilancia int, proyecto int,
    activo string, fecha_creacion timestamp, fecha_modificacion timestamp, start_publicacion timestamp,
    end_publicacion timestamp, fecha_eliminacion timestamp"""
SCHEMAS = {
    "usuario": """id int, id_depto int, id_ciudad int, id_tipo_usuario int, id_rol int, id_tipo_documento int,
        nombre string, razon_social string, correo_electronico string, direccion string, cedula string, nit string,
        telefono string, celular string, activo string, fecha_registro timestamp, fecha_modificacion timestamp""",
    "tipo_documento": "id int, codigo string, descripcion string",
    "ciudad": "id int, valor string, codigo_dane string, estado string",
    "habeas_data": "id int, id_usuario int, acepta int",
    "inmueble": INMUEBLE,
    "proyectos": """id_proyecto int, codigo_proyecto string, direccion string, nombre_proyecto string, id_ciudad int,
        id_localidad int, id_barrio int, id_departamento int, id_tipo_inmueble int, estrato int, id_usuario int,
        id_estado_proyecto int, latitud double, longitud double, estado string, fecha_creacion timestamp,
        fecha_modificacion timestamp, fecha_entrega timestamp""",
    "inmuebles_tipo": """id_inmueble_tipo int, id_proyecto int, codigo_tipo_propiedad string, nombre string,
        estado string""",
    "detalle_caracteristicas_inmueble": """id_detalle_inmueble int, id_inmueble int, id_caracteristica int,
        valor string""",
    "definicion_caracteristicas": "id_caracteristica int, alias string",
    "contacto": """id int, nombre string, correo_electronico string, celular string, mensaje string, tipo_doc string,
        cedula string, origin_lead string, fuente string, enviado_desde string, fecha timestamp, id_inmueble int""",
    "plan": """id int, codigo string, title string, description string, price double, months int,
        unidad_vigencia string, etiqueta_vigencia_servicio string, descripcion_superior_detalle string,
        caracteristicas_relevantes string, terminos_detalle string, activo string, carrito_id int,
        created_date timestamp, updated_date timestamp""",
    "producto_carrito": """id int, codigo string, nombre string, resumen string, precio double,
        etiqueta_vigencia_servicio string, descripcion_superior_detalle string, caracteristicas_relevantes string,
        terminos_detalle string, activo string, carrito_id int, fecha_creacion timestamp,
        fecha_actualizacion timestamp""",
    "portafolio_productos_usuario": """id int, usuario_id int, producto_id int, estado_portafolio_producto_id int,
        tipo_producto_portafolio_id int, cantidad_adquirida int, cantidad_usada int, fecha_creacion timestamp,
        fecha_inicio_vigencia timestamp, fecha_fin_vigencia timestamp""",
    "estado_portafolio_producto": "id int, nombre string",
    "cliente": """id int, id_tipo_documento int, nombre string, nombre_formulario string, numero_documento bigint,
        habeas_data int""",
    "correo_contacto_cliente": "id int, id_cliente int, correo_electronico string",
    "perfilamiento_cliente": """id int, id_registro_cliente int, id_tipo_transaccion int, perfilamiento string,
        fecha_creacion timestamp, fecha_modificacion timestamp""",
    "ofertas": """id int, comprador_id int, vendedor_id int, inmueble_id int, tipo_rechazo_id int, valor double,
        estado string, tipo string, motivo_rechazo string, datos_json string, fecha_creacion timestamp""",
    "ofertas_tipos_rechazo": "id int, opcion string",
}
SCHEMAS["contacto_proyecto"] = SCHEMAS["contacto"].replace("id_inmueble", "id_proyecto")
NAMED = "id int, valor string"

USER = dict(id_depto=1, id_ciudad=1, id_rol=1, correo_electronico="Ana@Mail.com", fecha_registro=DAY)
PLACE = dict(id_depto=1, id_ciudad=1, id_localidad=1, id_barrio=1, id_tipo_inmueble=1, estrato=3, id_usuario=1)
ROWS = {
    "usuario": [
        dict(id=1, nombre="ana maría", cedula="52", nit="9-1", id_tipo_usuario=1, id_tipo_documento=1, activo="0", **USER),
        dict(id=2, nombre="x", razon_social="CASAS SAS", cedula="53", nit="4000000000-1", id_tipo_usuario=2, activo="1",
             **USER),
        dict(id=3, razon_social="sola", cedula="54", id_tipo_usuario=1, activo="5", **USER),
        dict(id=4, nombre="sin tipo", razon_social="otra", cedula="55", nit="7", **USER),
        dict(id=5, nombre="ciudad vieja", **{**USER, "id_ciudad": 2}),
        dict(id=6, nombre="sin correo", **{**USER, "correo_electronico": None}),
    ],
    "tipo_documento": [dict(id=1, codigo="CC")],
    "tipo_usuario": [dict(id=1, valor="Persona Natural"), dict(id=2, valor="Inmobiliaria")],
    "rol": [dict(id=1, valor="DUEÑO de casa")],
    "ciudad": [dict(id=1, valor="Bogotá", codigo_dane="5001"), dict(id=2, valor="Vieja", codigo_dane="11001", estado="X"),
               dict(id=3, valor="Corta", codigo_dane="800")],
    "departamento": [dict(id=1, valor="Antioquia")],
    "localidad": [dict(id=1, valor="SUBA norte")],
    "barrio": [dict(id=1, valor="los ñandú")],
    "s_estrato": [dict(id=3, valor="Tres")],
    "s_tipo_inmueble": [dict(id=1, valor="Casa"), dict(id=2, valor="Oficina")],
    "s_estado_proyecto": [dict(id=1, valor="En obra")],
    "habeas_data": [dict(id=1, id_usuario=1, acepta=0), dict(id=2, id_usuario=1, acepta=1), dict(id=3, id_usuario=2, acepta=0)],
    "inmueble": [
        dict(id=10, codigo="P10", id_tipo_transaccion=3, precio_venta=Decimal("100.00"), area_construida=-30.0, proyecto=0,
             num_parqueaderos=-2, activo="0", permite_mascotas=1, gimnasio=1, vigilancia=2, electrodomesticos="nevera",
             enoferta=1, fecha_creacion=DAY, **PLACE),
        dict(id=11, codigo="P11", id_tipo_transaccion=9, area_bodega=0.0, area_lote=5.0, area_oficina=7.0, proyecto=1,
             nombre_proyecto=" Río Azul ", activo="4", electrodomesticos="0", fecha_creacion=DAY, **PLACE),
        dict(id=12, codigo="P12", id_tipo_transaccion=1, precio_venta=Decimal("5.00"), proyecto=0, activo="8",
             fecha_creacion=DAY, **{**PLACE, "id_barrio": None, "estrato": None}),
        dict(id=13, codigo="P13", proyecto=0, fecha_creacion=DAY, **{**PLACE, "id_usuario": 99}),
        dict(id=14, codigo="P14", proyecto=0, fecha_creacion=DAY, **{**PLACE, "id_ciudad": 77}),
        dict(id=15, proyecto=0, fecha_creacion=DAY, **PLACE),
        dict(id=16, codigo="P16", proyecto=0, fecha_creacion=DAY, **{**PLACE, "id_usuario": 2, "id_ciudad": 2}),
    ],
    "proyectos": [
        dict(id_proyecto=1, codigo_proyecto="PY1", nombre_proyecto="TORRE alta", id_departamento=1, id_ciudad=1,
             id_tipo_inmueble=1, id_usuario=2, id_estado_proyecto=1, estado="A", fecha_creacion=DAY, latitud=4.5),
        dict(id_proyecto=2, codigo_proyecto="PY2", nombre_proyecto="Local", id_departamento=1, id_ciudad=1,
             id_tipo_inmueble=2, id_usuario=2, id_estado_proyecto=1, estado="Z", fecha_creacion=DAY),
        dict(id_proyecto=3, codigo_proyecto="PY3", id_departamento=1, id_ciudad=1, id_usuario=2, id_estado_proyecto=9,
             fecha_creacion=DAY),
    ],
    "inmuebles_tipo": [
        dict(id_inmueble_tipo=100, id_proyecto=1, codigo_tipo_propiedad="PY1-B", nombre="Tipo B", estado="I"),
        dict(id_inmueble_tipo=101, id_proyecto=1, codigo_tipo_propiedad="PY1-A", nombre="Tipo A", estado="A"),
        dict(id_inmueble_tipo=102, id_proyecto=2, codigo_tipo_propiedad="PY2", nombre="Único"),
        dict(id_inmueble_tipo=103, id_proyecto=3, codigo_tipo_propiedad="PY3-A", nombre="Sin estado"),
        dict(id_inmueble_tipo=104, id_proyecto=1, codigo_tipo_propiedad="PY1-C", nombre="Sin atributos"),
    ],
    "detalle_caracteristicas_inmueble": [
        dict(id_detalle_inmueble=i, id_inmueble=e, id_caracteristica=a, valor=v) for i, (e, a, v) in enumerate([
            (100, 1, "200"), (100, 2, "3"), (100, 3, "2"), (100, 3, "9"), (100, 4, "true"), (100, 5, "true"), (101, 1, "1"),
            (102, 1, "50"), (102, 2, "0"), (102, 99, "lost"), (103, 1, "1"), (100, 6, "estufa")])
    ],
    "definicion_caracteristicas": [
        dict(id_caracteristica=i, alias=a) for i, a in enumerate(
            ["sellingPrice", "builtArea", "numBedRooms", "laundryZone", "allowPets", "homeAppliances"], 1)
    ],
    "contacto": [
        dict(id=1, nombre="LUIS díaz", correo_electronico="L@X.co", tipo_doc="1-cc", id_inmueble=10, fecha=DAY, celular="3"),
        dict(id=2, nombre="nadie", tipo_doc="otro", id_inmueble=13, fecha=DAY),
        dict(id=3, nombre="sin aviso", id_inmueble=999, fecha=DAY),
        dict(id=4, nombre="dos", tipo_doc="nit", id_inmueble=10, fecha=DAY),
    ],
    "contacto_proyecto": [
        dict(id=1, nombre="eva", correo_electronico="E@X.co", tipo_doc="Pasaporte", id_proyecto=1, fecha=DAY),
        dict(id=2, nombre="sin clase", id_proyecto=50, fecha=DAY),
    ],
    "plan": [
        dict(id=1, codigo="S1", title="Plan uno", price=9.5, months=3, unidad_vigencia="meses", activo="1", carrito_id=88,
             created_date=DAY),
        dict(id=2, codigo="S2", title="Plan dos", activo="0", created_date=DAY),
        dict(id=3, title="Sin código", activo="1"),
    ],
    "producto_carrito": [
        dict(id=1, codigo="C1", nombre="Banner", precio=1.0, activo="2", carrito_id=77, fecha_creacion=DAY),
        dict(id=2, codigo="S1", nombre="Repetido", precio=2.0, activo="1", carrito_id=66),
    ],
    "portafolio_productos_usuario": [
        dict(id=1, usuario_id=1, producto_id=1, estado_portafolio_producto_id=1, tipo_producto_portafolio_id=1,
             cantidad_adquirida=5, cantidad_usada=2, fecha_fin_vigencia=DAY),
        dict(id=2, usuario_id=1, producto_id=1, estado_portafolio_producto_id=1, tipo_producto_portafolio_id=2,
             fecha_fin_vigencia=dt.datetime(2024, 1, 1)),
        dict(id=3, usuario_id=1, producto_id=1, estado_portafolio_producto_id=1, tipo_producto_portafolio_id=3),
        dict(id=4, usuario_id=1, producto_id=1, estado_portafolio_producto_id=9, tipo_producto_portafolio_id=1),
        dict(id=5, usuario_id=None, producto_id=1, estado_portafolio_producto_id=1, tipo_producto_portafolio_id=1),
        dict(id=6, usuario_id=2, producto_id=2, estado_portafolio_producto_id=1, tipo_producto_portafolio_id=1),
    ],
    "estado_portafolio_producto": [dict(id=1, nombre="Vigente")],
    "cliente": [dict(id=1, id_tipo_documento=1, nombre="Caro", nombre_formulario="Web", numero_documento=3000000000,
                     habeas_data=1), dict(id=2, nombre="Beto")],
    "correo_contacto_cliente": [dict(id=1, id_cliente=1, correo_electronico="z@x"), dict(id=2, id_cliente=1,
                                correo_electronico="b@x"), dict(id=3, id_cliente=3, correo_electronico="c@x")],
    "perfilamiento_cliente": [
        dict(id=1, id_registro_cliente=1, id_tipo_transaccion=1, perfilamiento="p1", fecha_creacion=DAY),
        dict(id=2, id_registro_cliente=2, id_tipo_transaccion=2), dict(id=3, id_registro_cliente=3, id_tipo_transaccion=5),
    ],
    "ofertas": [dict(id=1, comprador_id=7, vendedor_id=8, inmueble_id=10, tipo_rechazo_id=1, valor=9.0, fecha_creacion=DAY),
                dict(id=2, inmueble_id=11), dict(id=3, inmueble_id=999), dict(id=4, inmueble_id=15)],
    "ofertas_tipos_rechazo": [dict(id=1, opcion="Bajo")],
}


@pytest.fixture(scope="module")
def tables(spark):
    def frame(name, rows):
        schema = SCHEMAS.get(name, NAMED)
        names = [f.name for f in parse_schema(schema)]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return {name: frame(name, rows) for name, rows in ROWS.items()}


@pytest.fixture(scope="module")
def built(tables):
    return {name: {r[product.key]: r for r in product.build(tables, AS_OF).collect()} for name, product in PRODUCTS.items()}


def test_users(built):
    users = built["app_users"]
    assert set(users) == {"1", "2", "3", "4"}, "old city and missing e-mail are left out"
    one = users["1"]
    assert (one.ds_email, one.ds_name, one.cd_identification_number, one.cd_identification_type) == (
        "ana@mail.com", "Ana María", "52", "CC")
    assert (one.cd_city_dane_code, one.cd_state_dane_code, one.ds_role, one.ds_status) == (
        "05001", "05", "Dueño De Casa", "Activo")
    assert [users[k].fl_is_contact_authorization for k in "1234"] == ["Si", "No", "No", "No"]
    assert [users[k].ds_name for k in "234"] == ["Casas Sas", "Sola", "Otra"]
    assert [users[k].cd_identification_number for k in "234"] == ["4000000000-1", "54", None]
    assert [users[k].ds_status for k in "234"] == ["Inactivo"] * 3


def test_used_properties(built):
    publications = built["properties_and_projects"]
    assert {k for k in publications if k.startswith("P1")} == {"P10", "P11", "P12", "P16"}
    ten = publications["P10"]
    assert (ten.nm_built_area, ten.nm_square_meter_price, ten.nm_parking_number) == (30.0, Decimal("3.33"), 2)
    assert (ten.ds_publication_status, ten.ds_publication_site_store, ten.ds_publication_type) == (
        "Activo", "Arriendo o venta", "Inmueble")
    assert ten.tx_url == "https://www.example.com/inmueble/casa-en-arriendo-o-venta-en-los-ñandu-bogota-10"
    assert (ten.fl_is_pet_allowed, ten.fl_has_gym, ten.fl_has_vigilance, ten.fl_has_home_appliances, ten.fl_has_pool,
            ten.fl_is_property_offer) == ("Si", "Si", "Si", "Si", "No", "Si")
    assert (ten.nm_publication_days_since_posted, ten.nm_elevator_number, ten.nm_property_age) == (29, 0, None)
    assert (ten.ds_neighborhood, ten.ds_district_division, ten.cd_neighborhood_economic_level) == (
        "Los Ñandú", "Suba Norte", "Tres")
    eleven = publications["P11"]
    assert (eleven.nm_built_area, eleven.nm_square_meter_price) == (5.0, None)
    assert (eleven.ds_publication_status, eleven.ds_publication_site_store) == ("Repetido", "Otro")
    assert eleven.tx_url == "https://www.example.com/proyecto/proyecto-rio-azul-en-los-ñandu-bogota-11"
    assert (eleven.fl_has_home_appliances, eleven.fl_has_vigilance) == ("No", "No")
    twelve = publications["P12"]
    assert (twelve.tx_url, twelve.nm_built_area, twelve.nm_square_meter_price) == ("https://www.example.com/", 0.0, None)
    assert (twelve.ds_publication_status, twelve.nm_property_selling_price) == ("Otro", Decimal("5.00"))


def test_project_classes(built):
    publications = built["properties_and_projects"]
    assert {k for k in publications if k.startswith("PY")} == {"PY1-A", "PY1-B", "PY2"}
    b = publications["PY1-B"]
    assert (b.ds_property_project_building_class_status, b.ds_publication_status) == ("Inactivo", "Activo")
    assert (b.nm_bedroom_number, b.nm_square_meter_price) == (2, Decimal("66.67")), "the first of two details counts"
    assert (b.fl_has_laundry_area, b.fl_is_pet_allowed, b.fl_has_home_appliances, b.fl_has_gym) == ("Si", "No", "Si", "No")
    assert b.tx_url == "https://www.example.com/proyecto-de-vivienda/x-torre-alta-bogota-1"
    assert (b.ds_property_project_name, b.ds_property_project_status, b.ds_publication_site_store) == (
        "Torre Alta", "En obra", "Nuevo")
    single = publications["PY2"]
    assert single.tx_url == "https://www.example.com/proyecto-comercial/x-local-bogota-2"
    assert (single.ds_publication_status, single.nm_square_meter_price, single.ds_property_project_building_class_status) == (
        "Eliminado", None, "Eliminado")


def test_leads(built):
    leads = built["leads"]
    assert set(leads) == {"1-U", "2-U", "4-U", "1-N"}
    assert (leads["1-U"].cd_identification_type, leads["1-U"].ds_name, leads["1-U"].ds_email) == ("CC", "Luis Díaz", "l@x.co")
    assert (leads["2-U"].cd_identification_type, leads["2-U"].id_user_app_identification_number,
            leads["2-U"].fl_is_registered_user) == ("OTRO", None, "No")
    assert (leads["1-N"].id_publication, leads["1-N"].cd_identification_type, leads["1-N"].fl_is_registered_user,
            leads["1-N"].id_user_app_identification_number) == ("PY1-A", "PA", "Si", "2")


def test_catalogue_and_purchases(built):
    catalogue = built["service_catalog"]
    assert set(catalogue) == {"S1", "S2", "C1"}
    assert (catalogue["C1"].nm_validity_period, catalogue["C1"].ds_unit_validity_period, catalogue["C1"].ds_status) == (
        None, "", "No")
    assert [catalogue[k].ds_status for k in ("S2",)] == ["Inactivo"]
    assert (catalogue["S1"].ds_type, catalogue["S1"].ds_name) == ("Producto", "Repetido"), "the greatest row wins a tie"
    bought = built["services_per_user"]
    assert {k: (v.id_service, v.ds_service_type, v.nm_purchased_services) for k, v in bought.items()} == {
        "1": ("S1", "Plan", 5), "2": ("C1", "Producto", None), "6": ("S2", "Plan", None)}
    assert bought["1"].dt_creation_date == DAY and bought["1"].ds_status == "Vigente"


def test_profiles(built):
    profiles = built["customer_profile"]
    one = profiles["1"]
    assert (one.ds_email, one.cd_identification_number, one.cd_identification_type, one.ds_transaction_type,
            one.fl_is_contact_authorization) == ("b@x", "3000000000", "CC", "Compra", "Si")
    assert (profiles["2"].ds_name, profiles["2"].ds_transaction_type, profiles["2"].ds_email) == ("Beto", "Arriendo", None)
    assert (profiles["3"].ds_name, profiles["3"].ds_transaction_type, profiles["3"].ds_email) == (None, "", None)


def test_offers(built):
    offers = built["property_offers"]
    assert set(offers) == {"1", "2"}, "unknown listings and listings without a code are left out"
    assert (offers["1"].id_property_offer_publication, offers["1"].ds_rejection_option, offers["2"].ds_rejection_option) == (
        "P10", "Bajo", None)


def test_declared_schemas(spark, tables):
    for name, schema in (("properties_and_projects", PROPERTIES_SCHEMA), ("app_users", USERS_SCHEMA), ("leads", LEADS_SCHEMA)):
        declared = [(f.name, f.dataType) for f in parse_schema(schema)]
        assert [(f.name, f.dataType) for f in PRODUCTS[name].build(tables, AS_OF).schema] == declared
    assert len(parse_schema(PROPERTIES_SCHEMA).fields) == 64
    for name, width in (("service_catalog", 15), ("services_per_user", 12), ("customer_profile", 13), ("property_offers", 12)):
        assert len(PRODUCTS[name].build(tables).columns) == width


def test_published_products_keep_rows_unless_replaced(spark, tables):
    target = KeyedTable(spark, scratch_path(spark, "publish"), "id_offer")
    publish("property_offers", tables, target, AS_OF)
    fewer = {**tables, "ofertas": tables["ofertas"].where("id = 2")}
    publish("property_offers", fewer, target, "2024-07-01 00:00:00")
    stamps = {r.id_offer: str(r.dt_product_date_time) for r in target.snapshot().collect()}
    assert stamps == {"1": "2024-06-30 12:00:00", "2": "2024-07-01 00:00:00"}
    publish("property_offers", fewer, target, AS_OF, replace=True)
    assert [r.id_offer for r in target.snapshot().collect()] == ["2"]


def test_marts(tables):
    products = {name: product.build(tables, AS_OF) for name, product in PRODUCTS.items()}
    marts = {name: mart(products) for name, mart in MARTS.items()}
    for name, columns in (("builders", BUILDERS_MART), ("agencies", AGENCIES_MART), ("persons", PERSONS_MART),
                          ("supply_demand", SUPPLY_DEMAND_MART)):
        assert tuple(marts[name].columns) == columns
    builders = {r.id_publication: r for r in marts["builders"].collect()}
    assert set(builders) == {"PY1-A", "PY1-B", "PY2"}
    assert (builders["PY1-A"]["Company Name"], builders["PY1-A"].MonoLead, builders["PY1-A"].Lead) == (
        "Casas Sas", "e@x.co", DAY)
    assert builders["PY1-B"]["id_publication[leads]"] is None
    agencies = marts["agencies"].collect()
    assert [(r.id_publication, r.Plan, r["ds_city_name[properties_and_projects]"], r.ds_city_name) for r in agencies] == [
        ("P16", "Plan dos", "Vieja", "Bogotá")]
    persons = marts["persons"].collect()
    assert len(persons) == 3 and {r["ds_name[service_catalog]"] for r in persons} == {"Repetido"}
    demand = marts["supply_demand"].collect()
    assert sorted(r.id_publication for r in demand) == ["P10", "P10", "P11", "P12", "P16", "PY1-A", "PY1-B", "PY2"]
    assert {r["dt_creation_date[leads]"] for r in demand} == {20240601, None} and {r.ds_country for r in demand} == {"Colombia"}
    assert marts["supply_demand"].schema["ds_country"].metadata == {"geographic_role": "COUNTY"}


def test_from_raw_files_to_products(spark, tables, built):
    """Feed files of every table, full load, products: the same offers and profiles as from the frames."""
    root = scratch_path(spark, "whole")
    job = JobConfig(f"{root}/raw", f"{root}/lake")
    names = ("property_offers", "customer_profile")
    for table in {t for name in names for t in PRODUCTS[name].reads}:
        schema = "clientes" if table in CUSTOMER_TABLES else "mercado"
        feed = tables[table].selectExpr("*", "'I' AS Op", "'2024-01-01 00:00:00' AS field_timestamp")
        feed_files(feed.coalesce(1), job.source(schema, table), "LOAD")
    load_all(spark, job, "fl")
    refresh(spark, job, "mercado", "clientes", names, AS_OF)
    for name in names:
        stored = KeyedTable(spark, job.target("products", name)).snapshot()
        assert {r[PRODUCTS[name].key]: r for r in stored.collect()} == built[name]
