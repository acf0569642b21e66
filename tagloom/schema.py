"""Column lists and dimension tables of the tag record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The order of the 29 columns of a tag record.
COLUMNS = [
    "filename", "product_name", "price_default", "price_card", "price_discount", "barcode", "discount_amount", "id_sku", "print_datetime", "code",
    "additional_info", "color", "special_symbols", "frame_timestamp", "x_min", "y_min", "x_max", "y_max", "qr_code_barcode", "price1_qr",
    "price2_qr", "price3_qr", "price4_qr", "wholesale_level_1_count", "wholesale_level_1_price", "wholesale_level_2_count", "wholesale_level_2_price",
    "action_price_qr", "action_code_qr",
]

#: The value of a field that the tag doesn't have; an unreadable one is blank.
ABSENT = "нет"

# The fields by the form of their numbers.
COORDINATES = ["x_min", "y_min", "x_max", "y_max"]
COMMA_PRICES = ["price_default", "price_card", "price_discount"]
DOT_PRICES = ["price1_qr", "price2_qr", "price3_qr", "price4_qr", "wholesale_level_1_price", "wholesale_level_2_price", "action_price_qr"]
PLACE = ["filename", "frame_timestamp", *COORDINATES]
#: What a reader fills in: everything but the place.
FIELDS = [c for c in COLUMNS if c not in PLACE]
SERVICE = ["__trk_id", "__preview_crop", "__preview_frame"]

# Fields of the headline score, and how each of the 23 is compared in the field report.
KPI_FIELDS = ["product_name", "price_default", "price_card", "price_discount", "barcode", "color", "discount_amount", "print_datetime"]
PRICE_FIELDS = [*COMMA_PRICES, *DOT_PRICES]
CODE_FIELDS = ["barcode", "qr_code_barcode", "id_sku"]
FUZZY_FIELDS = ["product_name", "additional_info"]

# Key names in code payloads for each field.
PAYLOAD_KEYS = {
    "qr_code_barcode": ["barcode", "b"],
    "price1_qr": ["price1", "p1"],
    "price2_qr": ["price2", "p2"],
    "price3_qr": ["price3", "p3"],
    "price4_qr": ["price4", "p4"],
    "wholesale_level_1_count": ["wholesaleLevel1Count", "wL1C"],
    "wholesale_level_1_price": ["wholesaleLevel1Price", "wL1P"],
    "wholesale_level_2_count": ["wholesaleLevel2Count", "wL2C"],
    "wholesale_level_2_price": ["wholesaleLevel2Price", "wL2P"],
    "action_price_qr": ["actionPrice", "aP"],
    "action_code_qr": ["actionCode", "aC"],
}

# The fields that a tag of each colour has; all others of FIELDS are optional there.
REQUIRED = {
    "red": ["product_name", "price_default", "price_card", "barcode", "color", "discount_amount", "id_sku", "special_symbols", "price1_qr", "price2_qr", "price4_qr", "qr_code_barcode"],
    "yellow": ["product_name", "price_default", "price_card", "barcode", "color", "id_sku", "print_datetime", "price1_qr", "price2_qr", "qr_code_barcode"],
    "green": ["product_name", "price_default", "price_card", "barcode", "color"],
    "white": ["product_name", "price_default", "barcode", "color"],
    "purple": ["product_name", "price_default", "price_card", "barcode", "color"],
    "orange": ["product_name", "price_default", "price_card", "barcode", "color"],
    "blue": ["product_name", "price_default", "price_card", "barcode", "color"],
}


def archetypes(spark: SparkSession, required: dict[str, list[str]] | None = None, fields: list[str] | None = None) -> DataFrame:
    """(color, optional array<string>): one row for each known colour; a handful of rows."""
    fields = fields or FIELDS
    rows = [(c, [f for f in fields if f not in have]) for c, have in (required or REQUIRED).items()]
    return spark.createDataFrame(rows, "color string, optional array<string>")
