"""Labels, code groups, key columns and column lists that results must carry exactly."""

from __future__ import annotations

# Change-feed envelope.
ENVELOPE = ("db", "table_name", "Op")
STAMP = "transaction_date_time"
FEED_STAMP = "field_timestamp"

# Key column per source table. Every table not listed is keyed by "id".
DEFAULT_KEY = "id"
OTHER_KEYS = {
    "definicion_caracteristicas": "id_caracteristica",
    "detalle_caracteristicas_inmueble": "id_detalle_inmueble",
    "fotos_inmueble": "id_foto_inmueble",
    "fotos_proyecto": "id_foto_proyecto",
    "inmuebles_tipo": "id_inmueble_tipo",
    "proyectos": "id_proyecto",
}

# Tables selected for ingestion, marketplace schema then customer schema.
MARKETPLACE_TABLES = (
    "producto_carrito", "s_estado_proyecto", "inmuebles_tipo", "definicion_caracteristicas", "tipo_documento",
    "s_estrato", "departamento", "tipo_usuario", "tipo_producto_portafolio", "rol", "localidad", "habeas_data",
    "estado_portafolio_producto", "contacto_proyecto", "contacto", "usuario", "transaccion_carrito",
    "s_tipo_inmueble", "proyectos", "portafolio_productos_usuario", "plan", "perfilamiento_cliente", "ofertas",
    "inmueble", "detalle_caracteristicas_inmueble", "ciudad", "caracteristicas_tipo", "barrio",
    "detalle_transaccion_carrito", "ofertas_tipos_rechazo", "plan_producto",
)
CUSTOMER_TABLES = ("perfilamiento_cliente", "correo_contacto_cliente", "cliente")

# Date-time columns that are ingested as text of at most 25 characters.
TEXT_DATES = {
    "rol": ("fecha",),
    "localidad": ("fecha",),
    "contacto": ("fecha_leido",),
    "ciudad": ("fecha",),
    "barrio": ("fecha",),
}
TEXT_DATE_LENGTH = 25
LONG_TIME_PATTERN = "yyyy-MM-ddHH:mm:ss.SSSSSS"

# Time pattern of the sources, and the zone of clock text.
TIME_PATTERN = "yyyy-MM-ddHH:mm:ss.SSSZ"
LOCAL_ZONE = "America/Bogota"

# yes/no labels and the texts read as each.
YES, NO = "Si", "No"
FALSE_TEXTS = ("0", "false")
TRUE_TEXTS = ("1", "true")

# Document types, each with the spellings that mean it. Unlisted spellings stay as they are.
DOCUMENT_TYPES = {
    "CC": ("CÉDULA DE CIUDADANIA", "1-CC", "01", "1", "CC - CÉDULA DE CIUDA", "CC"),
    "CE": ("5-CE", "CE", "CÉDULA DE EXTRANJERÍ", "5", "CÉDULA DE EXTRANJERÍA"),
    "NIT": ("2", "02", "NIT", "2-NIT", "NIT - Número de iden"),
    "PA": ("3", "PASAPORTE", "PA", "3-PA"),
    "TI": ("4-TI", "TI"),
    "SIDE": ("SIDE", "SIDE - Sin identific"),
    "RC": ("RC",),
    "PEP": ("PEP",),
    "TE": ("TE", "TE - Tarjeta de extr"),
    "TDE": ("TDE",),
}

# Status and transaction labels per source code; the last entry of each pair is the label for other codes.
PROJECT_STATUS = ({"A": "Activo", "I": "Inactivo"}, "Eliminado")
PROPERTY_STATUS = ({"0": "Activo", "1": "Inactivo", "2": "Eliminado", "4": "Repetido"}, "Otro")
PROPERTY_SITE = ({"1": "Venta", "2": "Arriendo", "3": "Arriendo o venta", "4": "Agenda"}, "Otro")
USER_STATUS = ({"0": "Activo", "1": "Inactivo"}, "Inactivo")
SERVICE_STATUS = ({"0": "Inactivo", "1": "Activo"}, "No")
PROFILE_TRANSACTION = ({"1": "Compra", "2": "Arriendo"}, "")
PET_FLAG = ({"0": "No", "1": "Si"}, "No")
VIGILANCE_CODES = ("1", "2")

# Publication kinds, service kinds, lead sources, user class of a person.
PROPERTY_KIND = "Inmueble"
PROJECT_KIND = "Proyecto Inmobiliario"
PROJECT_SITE = "Nuevo"
PLAN_KIND = "Plan"
PRODUCT_KIND = "Producto"
USED_LEAD, NEW_LEAD = "U", "N"
PERSON_CLASS = "Persona Natural"

# Address parts of a publication page and accent folding (other letters, such as ñ, stay).
HOUSING_TYPES = ("Casa", "Apartaestudio", "Apartamento", "Finca", "Lote")
HOUSING_PROJECT_PATH = "/proyecto-de-vivienda/"
COMMERCIAL_PROJECT_PATH = "/proyecto-comercial/"
PROPERTY_PATH = "/inmueble/"
PROPERTY_IN_PROJECT_PATH = "/proyecto/proyecto-"
ACCENTED, UNACCENTED = "áéíóú", "aeiou"

# Attribute aliases of a building class and the product column each one fills.
ATTRIBUTE_COLUMNS = {
    "sellingPrice": "nm_property_selling_price",
    "administrationValue": "nm_property_monthly_administration_fee",
    "builtArea": "nm_built_area",
    "privateArea": "nm_private_area",
    "numParking": "nm_parking_number",
    "numBedRooms": "nm_bedroom_number",
    "numBathrooms": "nm_bathroom_number",
    "balconiesNumber": "nm_balcony_number",
    "terracesNumber": "nm_terrace_number",
    "depositsNumber": "nm_storage_room_number",
    "allowPets": "fl_is_pet_allowed",
    "laundryZone": "fl_has_laundry_area",
    "privatePool": "fl_has_pool",
    "serviceRoom": "fl_has_service_room",
    "serviceBathroom": "fl_has_service_bathroom",
    "airConditioner": "fl_has_air_conditioner",
    "homeAppliances": "fl_has_home_appliances",
}

# Product schemas, in column order.
PROPERTIES_SCHEMA = """
    id_publication STRING NOT NULL, ds_publication_status STRING, ds_publication_type STRING NOT NULL,
    ds_publication_site_store STRING NOT NULL, id_publication_owner_app_identification_number STRING NOT NULL,
    ds_publication_owner_email STRING NOT NULL, ds_property_real_state_registration_number STRING,
    ds_property_type STRING, id_property_project STRING, ds_property_project_name STRING,
    ds_property_project_status STRING, id_property_project_building_class STRING,
    ds_property_project_building_class_name STRING, ds_property_project_building_class_status STRING,
    fl_is_property_offer STRING, cd_state_dane_code STRING NOT NULL, ds_state_name STRING NOT NULL,
    cd_city_dane_code STRING NOT NULL, ds_city_name STRING NOT NULL, ds_neighborhood STRING,
    ds_district_division STRING, cd_neighborhood_economic_level STRING, ds_address STRING, ds_latitude STRING,
    ds_longitude STRING, nm_property_selling_price DECIMAL(18,2) NOT NULL,
    nm_property_monthly_rent_payment DECIMAL(18,2) NOT NULL,
    nm_property_monthly_administration_fee DECIMAL(18,2) NOT NULL, nm_square_meter_price DECIMAL(18,2) NOT NULL,
    nm_built_area FLOAT NOT NULL, nm_private_area FLOAT NOT NULL, nm_parking_number INT,
    nm_visitors_parking_number INT, nm_bedroom_number INT, nm_bathroom_number INT, nm_property_age INT,
    nm_balcony_number INT, nm_terrace_number INT, fl_is_pet_allowed STRING, fl_has_laundry_area STRING,
    fl_has_green_zones STRING, nm_elevator_number INT, fl_has_communal_living STRING, fl_has_children_zone STRING,
    fl_has_pool STRING, fl_has_gym STRING, fl_has_service_room STRING, fl_has_service_bathroom STRING,
    fl_has_social_room STRING, fl_has_reception STRING, nm_storage_room_number INT, fl_has_air_conditioner STRING,
    fl_has_home_appliances STRING, fl_has_vigilance STRING, nm_publication_days_since_posted INT,
    dt_property_project_delivery_date TIMESTAMP, tx_url STRING, dt_creation_date TIMESTAMP NOT NULL,
    dt_modification_date TIMESTAMP, dt_property_inception_date TIMESTAMP, dt_property_expiration_date TIMESTAMP,
    dt_property_deletion_date TIMESTAMP, dt_product_date_time TIMESTAMP, dt_product_hudi_date_time TIMESTAMP
"""
USERS_SCHEMA = """
    id_app_identification_number STRING NOT NULL, ds_email STRING NOT NULL, cd_identification_type STRING,
    cd_identification_number STRING, ds_type STRING NOT NULL, ds_name STRING, ds_cellphone_number STRING,
    ds_phone_number STRING, ds_address STRING, cd_city_dane_code STRING NOT NULL, ds_city_name STRING NOT NULL,
    cd_state_dane_code STRING NOT NULL, ds_state_name STRING NOT NULL, fl_is_contact_authorization STRING NOT NULL,
    ds_role STRING NOT NULL, ds_status STRING NOT NULL, dt_creation_date TIMESTAMP NOT NULL,
    dt_modification_date TIMESTAMP, dt_product_date_time TIMESTAMP, dt_product_hudi_date_time TIMESTAMP
"""
LEADS_SCHEMA = """
    id_app_identification_number STRING NOT NULL, cd_identification_type STRING, cd_identification_number STRING,
    ds_email STRING NOT NULL, ds_name STRING NOT NULL, ds_cellphone_number STRING NOT NULL, tx_message STRING,
    id_user_app_identification_number STRING, id_publication STRING, fl_is_registered_user STRING,
    dt_creation_date TIMESTAMP NOT NULL, dt_product_date_time TIMESTAMP NOT NULL,
    dt_product_hudi_date_time TIMESTAMP NOT NULL
"""

# Columns that a product row must have.
PROPERTIES_REQUIRED = (
    "id_publication", "ds_publication_type", "ds_publication_site_store",
    "id_publication_owner_app_identification_number", "ds_publication_owner_email", "ds_state_name", "ds_city_name",
)
USERS_REQUIRED = (
    "id_app_identification_number", "ds_email", "cd_city_dane_code", "cd_state_dane_code", "ds_city_name",
    "ds_state_name", "fl_is_contact_authorization", "ds_role", "ds_status",
)
# Counts in which a missing number is zero.
ZERO_COUNTS = (
    "nm_parking_number", "nm_visitors_parking_number", "nm_bedroom_number", "nm_bathroom_number",
    "nm_balcony_number", "nm_terrace_number", "nm_elevator_number", "nm_storage_room_number",
)
PRODUCT_STAMPS = ("dt_product_date_time", "dt_product_hudi_date_time")

# Columns of the four reporting marts, in order. A name in brackets tells which product a column with a
# common name comes from.
BUILDERS_MART = (
    "Lead", "ds_status", "id_publication", "id_publication[leads]", "nm_parking_number", "ds_type", "ds_name",
    "Company Name", "nm_bathroom_number", "nm_property_selling_price", "ds_property_project_status", "nm_built_area",
    "nm_bedroom_number", "MonoLead", "ds_city_name[properties_and_projects]", "ds_property_project_name",
)
AGENCIES_MART = (
    "ds_state_name", "dt_creation_date[leads]", "ds_city_name", "ds_status", "Plan", "id_publication", "ds_name",
    "ds_city_name[properties_and_projects]", "DateUser",
)
PERSONS_MART = (
    "ds_property_type", "ds_publication_site_store", "ds_type", "ds_publication_status",
    "ds_city_name[properties_and_projects]", "id_app_identification_number", "ds_name[service_catalog]",
    "id_user_app_identification_number", "DateUser",
)
SUPPLY_DEMAND_MART = (
    "nm_balcony_number", "fl_has_pool", "fl_has_service_room", "nm_terrace_number", "fl_has_home_appliances",
    "CreationLeadDate", "fl_has_green_zones", "ds_state_name", "fl_has_social_room", "dt_creation_date[leads]",
    "ds_city_name", "nm_property_selling_price", "fl_has_service_bathroom", "nm_elevator_number",
    "ds_publication_site_store", "ds_neighborhood", "nm_bedroom_number", "ds_publication_status",
    "cd_neighborhood_economic_level", "id_app_identification_number", "nm_visitors_parking_number",
    "id_user_app_identification_number", "id_publication", "ds_country", "nm_parking_number", "fl_has_reception",
    "fl_has_air_conditioner", "fl_has_gym", "fl_is_pet_allowed", "nm_storage_room_number", "nm_bathroom_number",
    "ds_property_type", "fl_has_communal_living", "fl_has_children_zone", "nm_built_area", "CreationStockDate",
    "ds_district_division", "fl_has_laundry_area",
)
# Geographic roles of mart columns.
GEOGRAPHIC_ROLES = {"ds_state_name": "STATE", "ds_city_name": "CITY", "ds_country": "COUNTY"}
COUNTRY = "Colombia"
