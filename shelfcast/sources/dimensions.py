"""Customer, goods and warehouse dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.text import parse_number

# Warehouse to unit, as named in the stock files.
WAREHOUSE_UNITS = [
    ("ЛЫСЬВА ОСНОВНОЙ СКЛАД", "Лысьва"),
    ("КУНГУР ОСНОВНОЙ СКЛАД", "Кунгур"),
    ("ВЕРЕЩАГИНО ОСНОВНОЙ СКЛАД", "Верещагино"),
    ("БЕРЕЗНИКИ ОСНОВНОЙ СКЛАД", "Березники"),
    ("БЕРЕЗНИКИ НОРД", "Березники"),
    ("ПЕРМЬ ОСНОВНОЙ СКЛАД", "Пермь"),
    ("ЛЫСЬВА НОРД", "Лысьва"),
]

# Source column, report column of the goods table.
GOODS_NUMBERS = {
    "gl": "гл",
    "NetWeight": "весНетто",
    "GrossWeight": "весБрутто",
    "Packaging": "упаковка",
    "Rocase": "рокейс",
}
GOODS_TEXTS = {
    "Code": "Код",
    "Name": "Наименование",
    "GTIN": "GTIN",
    "SKU": "SKU",
    "SKU_Heineken": "SKU_Хайнекен",
    "English": "Англ",
    "Article": "Артикул",
    "BEREZNiki": "БЕРЕЗНИКИ",
    "Brand": "Бренд",
    "VERESHCHAGINO": "ВЕРЕЩАГИНО",
    "EXTERNAL_CODE_BORJOMI": "ВНЕШНИЙ_КОД_БОРЖОМИ",
    "GUBAKHA": "ГУБАХА",
    "CODE_LBD": "КОД_ЛБД",
    "CODE_NIDAN": "КОД_НИДАН",
    "Code_iSales": "Код_iSales",
    "Code_iSalesPepsi1": "Код_iSalesПепси1",
    "Code_iSalesPepsi2": "Код_iSalesПепси2",
    "Code_iSalesPepsi3": "Код_iSalesПепси3",
    "Code_iSalesPepsi4": "Код_iSalesПепси4",
    "Code_iSalesPepsi5": "Код_iSalesПепси5",
    "Code_RP": "Код_РП",
    "Strength": "Крепость",
    "KUDYMAR": "КУДЫМКАР",
    "KUNGUR": "КУНГУР",
    "LYSVA": "ЛЫСЬВА",
    "NameJTS": "НаименованиеJTS",
    "NomenclatureGroup_MPK": "Номенклатурная_группа_МПК",
    "MainProperty": "Основное_свойство",
    "PERM": "ПЕРМЬ",
    "PET_Container": "ПЭТ_тара",
    "Segment": "Сегмент",
    "ProductGroup": "Товарная_группа",
    "Packaging1": "Упаковка1",
    "CHERNUSHKA": "ЧЕРНУШКА",
}

# Columns the customer view renames; the others keep their names.
CUSTOMER_NAMES = {
    "name": "Наименование",
    "tax_id": "ИНН",
    "full_name": "Полное_наименование",
}


def warehouse_units(spark: SparkSession) -> DataFrame:
    """The seven warehouses and the unit each one serves."""
    return spark.createDataFrame(WAREHOUSE_UNITS, "warehouse string, unit string")


def goods_attributes(source: DataFrame) -> DataFrame:
    """Goods with trimmed texts, and numbers parsed from text with thousands commas."""
    texts = [F.trim(F.col(f"`{c}`")).alias(name) for c, name in GOODS_TEXTS.items()]
    numbers = [parse_number(F.col(f"`{c}`")).alias(name) for c, name in GOODS_NUMBERS.items()]
    return source.select(*texts, *numbers)


def customer_hierarchy(source: DataFrame) -> DataFrame:
    """The customer and its six parent levels."""
    parents = [c for i in range(1, 7) for c in (f"parent_{i}", f"parent_{i}_name")]
    return source.select(
        "child_code",
        *[F.col(c).alias(name) for c, name in CUSTOMER_NAMES.items()],
        *parents,
        "level",
    )
