"""Marketplace tables derived from the driver's tables.

Each is one projection, in SQL that Spark and DuckDB read alike, so that a product query and its oracle start from the
same rows. They keep the awkward cases of the real sources: missing owners and places, unknown codes, accents, blank
and missing text, numbers of either sign, several consents and e-mails per user, attributes given twice.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

STANDINS: dict[str, str] = {
    "usuario": """
        SELECT c_custkey AS id, c_nationkey % 6 AS id_depto,
               CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_nationkey END AS id_ciudad,
               CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'HOUSEHOLD' THEN 0
                    WHEN 'FURNITURE' THEN 3 END AS id_tipo_usuario,
               CAST(c_custkey % 6 AS INT) AS id_rol, c_nationkey % 7 AS id_tipo_documento,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE 'maría ' || lower(c_name) END AS nombre,
               CASE WHEN c_acctbal < 500 THEN NULL ELSE 'INMOBILIARIA ' || c_name END AS razon_social,
               CASE WHEN c_acctbal > 9900 THEN NULL ELSE 'Mail.' || c_name || '@Example.COM' END AS correo_electronico,
               'Calle ' || CAST(c_nationkey AS STRING) || ' # ' || CAST(c_custkey AS STRING) AS direccion,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey + 4000000000 AS STRING) END AS cedula,
               CAST(c_custkey + 900000 AS STRING) || '-' || CAST(c_custkey % 10 AS STRING) AS nit,
               CAST(6010000 + c_custkey AS STRING) AS telefono,
               CASE WHEN c_acctbal < 1000 THEN NULL ELSE CAST(3000000 + c_custkey AS STRING) END AS celular,
               CASE WHEN c_acctbal < 3000 THEN '1' WHEN c_acctbal < 6000 THEN '0' WHEN c_acctbal < 9000 THEN '7'
                    END AS activo,
               CAST('2020-03-01 08:30:00' AS TIMESTAMP) AS fecha_registro,
               CASE WHEN c_acctbal > 5000 THEN CAST('2023-03-01 10:00:00' AS TIMESTAMP) END AS fecha_modificacion
        FROM ${customer}""",
    "tipo_documento": """
        SELECT r_regionkey AS id, CASE r_regionkey WHEN 0 THEN 'CC' WHEN 1 THEN 'NIT' WHEN 2 THEN 'CE'
               WHEN 3 THEN 'PA' ELSE 'TI' END AS codigo, r_name AS descripcion FROM ${region}""",
    "tipo_usuario": """
        SELECT r_regionkey AS id, CASE r_regionkey WHEN 0 THEN 'Persona Natural' WHEN 1 THEN 'Inmobiliaria'
               ELSE 'Constructora' END AS valor FROM ${region}""",
    "rol": "SELECT r_regionkey AS id, 'ROL de ' || r_name AS valor FROM ${region}",
    "departamento": "SELECT r_regionkey AS id, 'Depto ' || r_name AS valor FROM ${region}",
    "s_estado_proyecto": """
        SELECT r_regionkey AS id, 'Etapa ' || r_name AS valor FROM ${region} WHERE r_name <> 'EUROPE'""",
    "ofertas_tipos_rechazo": "SELECT r_regionkey AS id, 'Motivo ' || lower(r_name) AS opcion FROM ${region}",
    "estado_portafolio_producto": "SELECT r_regionkey AS id, 'Estado ' || r_name AS nombre FROM ${region}",
    "ciudad": """
        SELECT n_nationkey AS id, CASE WHEN n_nationkey % 4 = 1 THEN ' Bogotá ' ELSE 'Ciudad ' END || n_name AS valor,
               CAST(800 + n_nationkey * 900 AS STRING) AS codigo_dane,
               CASE WHEN n_nationkey % 6 = 5 THEN 'X' END AS estado FROM ${nation}""",
    "localidad": "SELECT n_nationkey AS id, 'LOCALIDAD del ' || n_name AS valor FROM ${nation} WHERE n_nationkey <> 7",
    "barrio": "SELECT p_partkey AS id, ' ' || p_name || ' peñón' AS valor FROM ${part} WHERE p_size > 5",
    "s_estrato": "SELECT n_nationkey AS id, 'Estrato ' || CAST(n_nationkey AS STRING) AS valor FROM ${nation}",
    "s_tipo_inmueble": """
        SELECT n_nationkey AS id, CASE n_nationkey % 7 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Apartaestudio'
               WHEN 2 THEN 'Apartamento' WHEN 3 THEN 'Finca' WHEN 4 THEN 'Lote' WHEN 5 THEN 'Oficina'
               ELSE 'Bodega' END AS valor FROM ${nation} WHERE n_nationkey <> 11""",
    "habeas_data": """
        SELECT o_orderkey AS id, o_custkey AS id_usuario, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS acepta
        FROM ${orders}""",
    "inmueble": """
        SELECT o_orderkey AS id, CAST(o_custkey % 7 AS INT) AS id_depto, CAST(o_custkey % 26 AS INT) AS id_ciudad,
               CAST(o_orderkey % 25 AS INT) AS id_localidad, o_custkey AS id_barrio,
               CAST(o_orderkey % 25 AS INT) AS id_tipo_inmueble, o_custkey + 20 AS id_usuario,
               CAST(o_custkey % 25 AS INT) AS estrato,
               CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                    WHEN '5-LOW' THEN 4 ELSE 9 END AS id_tipo_transaccion,
               CASE WHEN o_totalprice > 480000 THEN NULL ELSE 'P' || CAST(o_orderkey AS STRING) END AS codigo,
               'Carrera ' || CAST(o_custkey AS STRING) AS direccion,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '50C-' || CAST(o_orderkey AS STRING)
                    END AS matricula_inmobiliaria,
               'Torres del ' || o_orderpriority AS nombre_proyecto,
               '4.' || CAST(o_orderkey AS STRING) AS latitud, '-74.' || CAST(o_custkey AS STRING) AS longitud,
               CASE WHEN o_totalprice < 20000 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS precio_venta,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS canon_arrendamiento,
               CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS DECIMAL(18,2)) END AS valor_administracion,
               o_custkey % 4 - 1 AS num_parqueaderos, o_orderkey % 6 AS num_habitaciones,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 4 END AS num_banos,
               CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 30 END AS antiguedad,
               o_orderkey % 3 AS num_balcones, 0 - o_orderkey % 2 AS num_terraza, o_custkey % 2 AS num_depositos,
               CASE WHEN o_orderstatus = 'F' THEN 2 END AS num_ascensores, o_custkey % 9 AS num_parqueaderos_visitantes,
               CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 70 END AS area_bodega, o_orderkey % 3 AS area_oficina,
               CASE WHEN o_orderkey % 5 = 1 THEN 0 - o_custkey % 90 END AS area_lote,
               CASE WHEN o_orderkey % 5 < 3 THEN 0 WHEN o_orderkey % 5 = 3 THEN NULL ELSE 0 - o_custkey % 150 - 20
                    END AS area_construida,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 120 END AS area_privada,
               o_orderkey % 2 AS cuarto_servicio, o_orderkey % 3 AS bano_servicio, o_custkey % 2 AS zona_lavanderia,
               o_custkey % 3 AS aire_acondicionado, o_orderkey % 2 AS recepcion, o_custkey % 2 AS sede_social,
               o_orderkey % 3 AS salon_comunal, o_custkey % 3 AS zona_infantil, o_orderkey % 4 AS zonas_verdes,
               o_custkey % 4 AS piscina_comunal, o_orderkey % 5 AS gimnasio, o_custkey % 2 AS permite_mascotas,
               CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS enoferta,
               CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN 'nevera' END AS electrodomesticos,
               CAST(o_orderkey % 4 AS INT) AS vigilancia, CAST(o_custkey % 2 AS INT) AS proyecto,
               CAST(o_custkey % 6 AS STRING) AS activo, o_orderdate AS fecha_creacion,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL '30' DAY END AS fecha_modificacion,
               o_orderdate + INTERVAL '1' DAY AS start_publicacion, o_orderdate + INTERVAL '90' DAY AS end_publicacion,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL '60' DAY END AS fecha_eliminacion
        FROM ${orders}""",
    "proyectos": """
        SELECT p_partkey AS id_proyecto, 'PY' || CAST(p_partkey AS STRING) AS codigo_proyecto,
               'Avenida ' || p_brand AS direccion, p_name || ' ' || p_type AS nombre_proyecto,
               CAST(p_partkey % 26 AS INT) AS id_ciudad, CAST(p_partkey % 25 AS INT) AS id_localidad,
               p_partkey AS id_barrio, CAST(p_partkey % 6 AS INT) AS id_departamento,
               CAST(p_partkey % 25 AS INT) AS id_tipo_inmueble, p_size AS estrato, p_partkey AS id_usuario,
               CAST(p_partkey % 5 AS INT) AS id_estado_proyecto, p_size AS latitud, 0 - p_size AS longitud,
               CASE p_type WHEN 'PROMO' THEN 'A' WHEN 'LARGE' THEN 'I' WHEN 'SMALL' THEN 'E' END AS estado,
               CAST('2021-05-01 00:00:00' AS TIMESTAMP) AS fecha_creacion,
               CASE WHEN p_size > 25 THEN CAST('2022-05-01 12:00:00' AS TIMESTAMP) END AS fecha_modificacion,
               CAST('2026-01-01 00:00:00' AS TIMESTAMP) AS fecha_entrega
        FROM ${part}""",
    "inmuebles_tipo": """
        SELECT p_partkey * 2 AS id_inmueble_tipo, p_partkey AS id_proyecto,
               CASE WHEN p_size = 1 THEN 'PY' || CAST(p_partkey AS STRING)
                    ELSE 'PY' || CAST(p_partkey AS STRING) || '-A' END AS codigo_tipo_propiedad,
               'Tipo A ' || p_name AS nombre, 'A' AS estado FROM ${part}
        UNION ALL
        SELECT p_partkey * 2 + 1, p_partkey, 'PY' || CAST(p_partkey AS STRING) || '-B', 'Tipo B ' || p_name,
               CASE WHEN p_type = 'PROMO' THEN 'I' END FROM ${part} WHERE p_size > 10""",
    "definicion_caracteristicas": """
        SELECT n_nationkey AS id_caracteristica,
               CASE n_nationkey WHEN 0 THEN 'sellingPrice' WHEN 1 THEN 'administrationValue' WHEN 2 THEN 'builtArea'
               WHEN 3 THEN 'privateArea' WHEN 4 THEN 'numParking' WHEN 5 THEN 'numBedRooms' WHEN 6 THEN 'numBathrooms'
               WHEN 7 THEN 'balconiesNumber' WHEN 8 THEN 'terracesNumber' WHEN 9 THEN 'depositsNumber'
               WHEN 10 THEN 'allowPets' WHEN 11 THEN 'laundryZone' WHEN 12 THEN 'privatePool'
               WHEN 13 THEN 'serviceRoom' WHEN 14 THEN 'serviceBathroom' WHEN 15 THEN 'airConditioner'
               WHEN 16 THEN 'homeAppliances' ELSE 'other' END AS alias FROM ${nation}""",
    "detalle_caracteristicas_inmueble": """
        SELECT l_orderkey * 10 + l_linenumber AS id_detalle_inmueble, l_partkey * 2 + l_linenumber % 2 AS id_inmueble,
               CAST(floor(l_quantity) AS INT) % 19 AS id_caracteristica,
               CASE WHEN floor(l_quantity) % 19 < 2 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING)
                    WHEN floor(l_quantity) % 19 < 4 THEN CAST(l_suppkey AS STRING)
                    WHEN floor(l_quantity) % 19 < 10 THEN CAST(l_linenumber AS STRING)
                    WHEN l_returnflag = 'A' THEN 'true' WHEN l_returnflag = 'N' THEN 'false'
                    WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS valor
        FROM ${lineitem}""",
    "contacto": """
        SELECT event_id AS id, event_type || ' lópez' AS nombre,
               CASE WHEN event_type = 'error' THEN NULL ELSE 'User' || CAST(user_id AS STRING) || '@Mail.com'
                    END AS correo_electronico,
               CASE WHEN user_id % 3 = 0 THEN NULL ELSE CAST(3100000 + user_id AS STRING) END AS celular,
               props AS mensaje, ts AS fecha, user_id * 120 AS id_inmueble,
               CASE user_id % 9 WHEN 0 THEN '1-cc' WHEN 1 THEN 'Nit' WHEN 2 THEN 'cédula de extranjerí'
                    WHEN 3 THEN 'pasaporte' WHEN 4 THEN '4-TI' WHEN 5 THEN 'te' WHEN 6 THEN 'otro'
                    WHEN 7 THEN 'pep' END AS tipo_doc,
               CAST(user_id + 52000000 AS STRING) AS cedula, 'web' AS origin_lead, event_type AS fuente,
               'app' AS enviado_desde
        FROM ${events}""",
    "contacto_proyecto": """
        SELECT doc_id AS id, 'ana ' || source AS nombre,
               CASE WHEN lang = 'fr' THEN NULL ELSE 'Doc' || CAST(doc_id AS STRING) || '@Mail.com'
                    END AS correo_electronico,
               CAST(3200000 + doc_id AS STRING) AS celular, text AS mensaje,
               CAST('2024-02-01 09:00:00' AS TIMESTAMP) AS fecha, doc_id * 2 AS id_proyecto,
               CASE lang WHEN 'en' THEN '01' WHEN 'fr' THEN '02' WHEN 'de' THEN 'side' ELSE '9' END AS tipo_doc,
               CAST(n_chars AS STRING) AS cedula, 'web' AS origin_lead, source AS fuente, 'portal' AS enviado_desde
        FROM ${documents}""",
    "plan": """
        SELECT p_partkey AS id, CASE WHEN p_size = 50 THEN NULL ELSE 'PL' || CAST(p_partkey AS STRING) END AS codigo,
               p_name AS title, p_type AS description, p_retailprice AS price, p_brand AS etiqueta_vigencia_servicio,
               'Detalle ' || p_brand AS descripcion_superior_detalle, 'Relevante ' || p_type
               AS caracteristicas_relevantes, 'Términos ' || p_brand AS terminos_detalle, p_size AS months,
               CASE WHEN p_size < 20 THEN 'meses' END AS unidad_vigencia,
               CASE p_type WHEN 'PROMO' THEN '1' WHEN 'LARGE' THEN '0' WHEN 'SMALL' THEN '3' ELSE '1' END AS activo,
               p_partkey AS carrito_id, CAST('2019-01-01 00:00:00' AS TIMESTAMP) AS created_date,
               CASE WHEN p_size > 30 THEN CAST('2019-06-01 00:00:00' AS TIMESTAMP) END AS updated_date
        FROM ${part}""",
    "producto_carrito": """
        SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 = 3 THEN 'PL' ELSE 'PR' END || CAST(s_suppkey AS STRING)
               AS codigo, s_name AS nombre, 'Resumen ' || s_name AS resumen, s_acctbal AS precio,
               'mes' AS etiqueta_vigencia_servicio, 'Detalle ' || s_name AS descripcion_superior_detalle,
               CASE WHEN s_acctbal > 0 THEN 'Relevante' END AS caracteristicas_relevantes,
               'Términos' AS terminos_detalle, CASE WHEN s_acctbal > 1000 THEN '1' ELSE '0' END AS activo,
               s_nationkey AS carrito_id, CAST('2018-01-01 00:00:00' AS TIMESTAMP) AS fecha_creacion,
               CAST(NULL AS TIMESTAMP) AS fecha_actualizacion
        FROM ${supplier}""",
    "portafolio_productos_usuario": """
        SELECT o_orderkey AS id, CASE WHEN o_totalprice > 490000 THEN NULL ELSE o_custkey END AS usuario_id,
               CAST(floor(o_custkey / 10) AS BIGINT) AS producto_id,
               CAST(o_orderkey % 6 AS INT) AS estado_portafolio_producto_id,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS tipo_producto_portafolio_id,
               o_custkey % 5 AS cantidad_adquirida, o_custkey % 3 AS cantidad_usada, o_orderdate AS fecha_creacion,
               o_orderdate + INTERVAL '1' DAY AS fecha_inicio_vigencia,
               o_orderdate + INTERVAL '365' DAY AS fecha_fin_vigencia
        FROM ${orders}""",
    "cliente": """
        SELECT c_custkey AS id, c_nationkey % 6 AS id_tipo_documento, c_name AS nombre,
               'Formulario ' || c_mktsegment AS nombre_formulario, c_custkey + 70000000 AS numero_documento,
               CASE WHEN c_acctbal > 4000 THEN 1 WHEN c_acctbal > 0 THEN 0 END AS habeas_data
        FROM ${customer}""",
    "correo_contacto_cliente": """
        SELECT o_orderkey AS id, o_custkey AS id_cliente,
               'c' || CAST(o_custkey AS STRING) || '.' || lower(o_orderpriority) || '@mail.com' AS correo_electronico
        FROM ${orders}""",
    "perfilamiento_cliente": """
        SELECT o_orderkey AS id, o_custkey + 50 AS id_registro_cliente,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS id_tipo_transaccion,
               'Busca ' || o_orderpriority AS perfilamiento, o_orderdate AS fecha_creacion,
               CASE WHEN o_totalprice > 250000 THEN o_orderdate + INTERVAL '10' DAY END AS fecha_modificacion
        FROM ${orders}""",
    "ofertas": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS comprador_id, l_partkey AS vendedor_id,
               l_orderkey + 1000 AS inmueble_id, l_linenumber AS tipo_rechazo_id, l_extendedprice AS valor,
               l_returnflag AS estado, l_linestatus AS tipo,
               CASE WHEN l_returnflag = 'R' THEN 'Precio' END AS motivo_rechazo, 'datos' AS datos_json,
               l_shipdate AS fecha_creacion
        FROM ${lineitem}""",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def standins(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """The named marketplace tables as frames."""
    sources: dict[str, DataFrame] = {}
    found = {}
    for name in names:
        text = string.Template(STANDINS[name])
        used = {t for t in SOURCES if "${" + t + "}" in STANDINS[name]}
        for table in used - sources.keys():
            sources[table] = read(spark, folder, table)
        found[name] = spark.sql(text.substitute({t: "{" + t + "}" for t in used}), **{t: sources[t] for t in used})
    return found


def standin_ctes(names) -> str:
    """The same tables as common table expressions."""
    return ",\n".join(
        f"{name} AS ({string.Template(STANDINS[name]).substitute({t: t for t in SOURCES})})" for name in names
    )
