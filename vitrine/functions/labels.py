"""Display labels and categories of the statistics reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Catalog and object-type labels, as (label, pretty, at most 32
# characters).  None: the pretty form serves.
CATALOG_LABELS = [
    ("No collection manager (Registration)", "None (Registration)", None),
    ("Cat.  1: California (archaeology and ethnology)", "Cat. 1: California", None),
    ("Cat.  2 - North America (except Mexico and Central America)", "Cat. 2: North America", None),
    ("Cat.  3 - Mexico, Central America, and Caribbean Area", "Cat. 3: Mexico, Cent. Am., and Carib.", "Cat. 3: Mexico, C. Am., & Carib."),
    ("Cat.  4 - South America (Uhle Collection)", "Cat. 4: South America (Uhle)", None),
    ("Cat.  5 - Africa (except the Hearst Reisner Egyptian Collection)", "Cat. 5: Africa (except Reisner)", None),
    ("Cat.  6 - Ancient Egypt (the Hearst Reisner Egyptian Collection)", "Cat. 6: Ancient Egypt (Reisner)", None),
    ("Cat.  7 - Europe (incl. Russia west of Urals, north of Caucasus)", "Cat. 7: Europe", None),
    ("Cat.  8 - Classical Mediterranean regions", "Cat. 8: Classical Mediterranean", None),
    ("Cat.  9 - Asia (incl. Russia east of Urals)", "Cat. 9: Asia", None),
    ("Cat. 10 - Philippine Islands", "Cat. 10: Philippine Islands", None),
    ("Cat. 11 - Oceania (incl. Australia)", "Cat. 11: Oceania (incl. Australia)", "Cat. 11: Oceania (w/ Australia)"),
    ("Cat. 13 - Photographic prints (without negatives)", "Cat. 13: Photographic prints", None),
    ("Cat. 15 - Photographic negatives", "Cat. 15: Photographic negatives", None),
    ("Cat. 16 - South America (except Uhle Collection)", "Cat. 16: South America (except Uhle)", "Cat. 16: So. America (not Uhle)"),
    ("Cat. 17 - Drawings and Paintings", "Cat. 17: Drawings and paintings", None),
    ("Cat. 18 - Malaysia (incl. Indonesia, excl. Philippine Islands)", "Cat. 18: Malaysia", None),
    ("Cat. 22 - Rubbings of Greek & Latin Inscriptions", "Cat. 22: Rubbings", None),
    ("Cat. 23 - No provenience (most of catalog deleted)", "Cat. 23: No provenience", None),
    ("Cat. 25 - Kodachrome color transparencies", "Cat. 25: Color slides", None),
    ("Cat. 26 - Motion picture film", "Cat. 26: Motion picture film", None),
    ("Cat. 28 - unknown (retired catalog)", "Cat. 28: unknown (retired catalog)", "Cat. 28: unknown (retired cat.)"),
    ("Cat. B - Barr collection", "Cat. B: Barr collection", None),
    ("Cat. K - Kelly collection", "Cat. K: Kelly collection", None),
    ("Cat. L - Lillard Collection", "Cat. L: Lillard collection", None),
    ("NAGPRA-associated Funerary Objects", "NAGPRA AFOs", None),
    ("Faunal Remains", "Faunal remains", None),
    ("Human Remains", "Human remains", None),
]

# Use codes, as (label, at most 32 characters).
USE_LABELS = [
    ("1.0 Use not specified (Utensils, Implements, and Conveyances)", "1.0 Utensils, implements, etc."),
    ("1.1 Hunting and Fishing", "1.1 Hunting and fishing"),
    ("1.2 Gathering", "1.2 Gathering"),
    ("1.3 Agriculture and Animal Husbandry", "1.3 Agriculture, animal husbandry"),
    ("1.4 Transportation", "1.4 Transportation"),
    ("1.5 Household", "1.5 Household"),
    ("1.6 Manufacturing, Constructing, Craft, and Professional Pursuits", "1.6 Manufacturing, craft, etc."),
    ("1.7 Fighting, Warfare, and Social Control", "1.7 Fighting, warfare, social control"),
    ("1.8 Toilet Articles", "1.8 Toilet articles"),
    ("1.9 Multiple Utility", "1.9 Multiple utility"),
    ("2.0 Use not specified (Secular Dress and Accoutrements, and Adornment)", "2.0 Secular dress, adornment"),
    ("2.1 Daily Garb", "2.1 Daily garb"),
    ("2.2 Personal Adornments and Accoutrements", "2.2 Personal adornments, etc."),
    ("2.3 Special Ornaments, Garb, and Finery Worn to Battle by Warrior (excluding status insignia)", "2.3 Special ornaments for battle"),
    ("2.4 Fine Clothes and Accoutrements not used exclusively for status or religious purposes", "2.4 Fine clothes, non-religious"),
    ("3.1 Status Objects and Insignia of Office", "3.1 Status objects, insignia of office"),
    ("4.0 Use not specified (Structures and Furnishings)", "4.0 Structures and furnishings"),
    ("4.1 Dwellings and Furnishings", "4.1 Dwellings and furnishings"),
    ("4.2 Public Buildings and Furnishings", "4.2 Public buildings, furnishings"),
    ("4.3 Storehouses, Granaries, and the Like", "4.3 Storehouses, granaries, etc."),
    ("5.0 Use not specified (Ritual, Pageantry, and Recreation)", "5.0 Ritual, pageantry, and recreation"),
    ("5.1 Religion and Divination: Objects and garb associated with practices reflecting submission, devotion, obedience, and service to supernatural agencies", "5.1 Religion & divination"),
    ("5.2 Magic: Objects Associated with Practices reflecting confidence in the ability to manipulate supernatural agencies", "5.2 Magic, assoc. objects"),
    ("5.3 Objects relating to the Secular and Quasi-religious Rites, Pageants, and Drama", "5.3 For quasi-religious rites, etc."),
    ("5.4 Secular and Religious Musical Instruments", "5.4 Musical instruments"),
    ("5.5 Stimulants, Narcotics, and Accessories", "5.5 Stimulants, narcotics"),
    ("5.6 Sports, Games, Amusements; Gambling and Pet Accessories", "5.6 Sports, games, gambling, pets"),
    ('5.7 Gifts, Novelties, Models, "Fakes," and Reproductions (excluding currency) and Commemorative Medals', "5.7 Gifts, models, reproductions"),
    ("6.0 Use not specified (Child Care and Enculturation)", "6.0 Child care and enculturation"),
    ("6.1 Cradles and Swaddling", "6.1 Cradles and swaddling"),
    ("6.2 Toys, Children's Utensils, Objects used in the Education of Children", "6.2 Children's toys, utensils, etc."),
    ("7.0 Use not specified (Communication, Records, Currency, and Measures)", "7.0 Communication, currency, measures"),
    ("7.1 Writing and Records (including religious texts)", "7.1 Writing and records"),
    ("7.2 Sound Communication", "7.2 Sound communication"),
    ("7.3 Weights, Measures, and Computing Devices", "7.3 Weights, measures, etc."),
    ("7.4 Non-issued Media of Exchange, Symbolic Valuables, and Associated Containers", "7.4 Media of exchange, symb. value"),
    ("7.5 Issued Currency and Associated Containers", "7.5 Issued currency, containers"),
    ("8.0 Use not specified (Raw Materials)", "8.0 Raw materials"),
    ("8.1 Foods", "8.1 Foods"),
    ("8.2 Medicine and Hygiene", "8.2 Medicine and Hygiene"),
    ("8.3 For Manufacturing", "8.3 For Manufacturing"),
    ("8.4 Fuels", "8.4 Fuels"),
    ("8.5 Multiple Utility", "8.5 Multiple Utility"),
]

# Brief forms that no rule gives.
BRIEF_LABELS = {
    "No collection manager (Registration)": "Registr.",
    "NAGPRA-associated Funerary Objects": "AFOs",
    "Faunal Remains": "Fauna",
    "Human Remains": "HSR",
    "Mixed faunal and human remains": "Mixed",
    "Casts and molds": "Casts",
    "Audio recordings": "Audio",
    "Cat. Bascom": "Bascom",
    "6.2 Toys, Children’s Utensils, Objects used in the Education of Children": "6.2",
    "7.6 Bogus Currency": "7.6",
}

# Category of a status.
STATUS_CATEGORIES = {
    "accessioned": "Accession Status",
    "number not used": "Accession Status",
    "deaccessioned": "Accession Status",
    "accession status unclear": "Accession Status",
    "None": "Accession Status",
    "(unknown)": "Accession Status",
    "partially deaccessioned": "Accession Status",
    "not cataloged": "Accession Status",
    "recataloged": "Deaccession Reason",
    "transferred": "Deaccession Reason",
    "missing": "Deaccession Reason",
    "repatriated": "Deaccession Reason",
    "sold": "Deaccession Reason",
    "exchanged": "Deaccession Reason",
    "discarded": "Deaccession Reason",
    "partially exchanged": "Deaccession Reason",
    "destructive analysis": "Deaccession Reason",
    "destroyed": "Deaccession Reason",
    "partially recataloged": "Deaccession Reason",
    "stolen": "Deaccession Reason",
    "culturally affiliated": "Cultural Affiliation",
    "culturally unaffiliated": "Cultural Affiliation",
}

# Word in the label and what it stands for; the first hit wins.
CONTINENTS = [
    ("North American", "North America"),
    ("South American", "South America"),
    ("African", "Africa"),
    ("Asian", "Asia"),
    ("European", "Europe"),
    ("Oceanian", "Oceania"),
]
DISCIPLINES = [
    ("ethnography", "Ethnography"),
    ("archaeology", "Archaeology"),
    ("indeterminate", "Indeterminate"),
    ("not specified", "Not Specified"),
    ("sample", "Sample"),
    ("documentation", "Documentation"),
    ("unknown", "Unknown"),
    ("none", "None"),
]

# Titles of the headline metrics.
METRIC_NAMES = {
    "totalMusNoCount": "Total Museum Numbers",
    "trueObjectCount": "Object Count",
    "truePieceCount": "Piece Count",
}


def label_table(style: str) -> dict[str, str]:
    """Label to display form: ``pretty``, ``terse`` (32) or ``brief`` (7)."""
    if style == "pretty":
        return {label: pretty for label, pretty, _ in CATALOG_LABELS}
    if style == "terse":
        return {label: terse or pretty for label, pretty, terse in CATALOG_LABELS} | dict(USE_LABELS)
    if style == "brief":
        catalogs = {
            label: "Cat. " + found[1]
            for label, *_ in CATALOG_LABELS
            if (found := re.match(r"Cat\. +(\w+)", label))
        }
        # the brief list spells the children's label with a curly apostrophe only
        uses = {label: label[:3] for label, _ in USE_LABELS if not label.startswith("6.2")}
        return catalogs | uses | BRIEF_LABELS
    raise ValueError(f"unknown label style: {style}")


def _lookup(df: DataFrame, col: str, table: dict[str, str], out: str, default: Column) -> DataFrame:
    """Left join to a fixed table of at most a hundred rows, so broadcast is safe."""
    rows = df.sparkSession.createDataFrame(list(table.items()), "_label string, _shown string")
    joined = df.join(F.broadcast(rows), F.col(col) == F.col("_label"), "left")
    return joined.withColumn(out, F.coalesce("_shown", default)).drop("_label", "_shown")


def pretty_label(df: DataFrame, col: str, style: str = "pretty", out: str | None = None) -> DataFrame:
    """Display form of a label; an unknown label passes through."""
    return _lookup(df, col, label_table(style), out or col, F.col(col))


def status_category(df: DataFrame, col: str, out: str = "category") -> DataFrame:
    return _lookup(df, col, STATUS_CATEGORIES, out, F.lit("Other"))


def split_area_category(col: Column | str) -> Column:
    """(discipline, continent) that a label's words name, ``Other`` if none does."""
    c = F.col(col) if isinstance(col, str) else col

    def first_hit(rules: list[tuple[str, str]]) -> Column:
        cases = F
        for word, value in rules:
            cases = cases.when(c.contains(word), F.lit(value))
        return cases.otherwise(F.lit("Other"))

    return F.struct(first_hit(DISCIPLINES).alias("discipline"), first_hit(CONTINENTS).alias("continent"))


def metric_name(col: Column | str) -> Column:
    """Title of a metric code; an unknown code passes through."""
    c = F.col(col) if isinstance(col, str) else col
    cases = F
    for code, title in METRIC_NAMES.items():
        cases = cases.when(c == code, F.lit(title))
    return cases.otherwise(c)
