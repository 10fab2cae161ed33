"""Names and categories of ICD-10 style cause codes.

Codes are chapter letters, ranges (``J12-J18``), range unions (``J45_J46``) or aggregates, each
optionally with an ``_OTH`` suffix for "other". ``stem`` below is the code without that suffix.
The rules are tables looked up in a fixed order; they run on the distinct codes of a dimension.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER_SUFFIX = "_OTH"
ALL_CAUSES = "A-R_V-Y"
ALL_CONDITIONS = "A-T_Z"
ALL_CONDITIONS_NAME = "All diseases and health factors (A-T, Z)"

# Names of whole chapters; these never carry the "other" mark.
CHAPTER_NAMES = {
    "C": "All neoplasms",
    "I": "All circulatory diseases",
}
# Names of groups matched by the whole stem.
EXACT_GROUPS = {
    "J00-J11": "Acute upper respiratory infections",
    "J12-J18": "Pneumonia",
    "J20-J22": "Other acute lower respiratory infections",
    "J40-J44": "Chronic lower respiratory diseases (COPD)",
    "J40-J44_J47": "Chronic lower respiratory diseases (COPD)",
    "J45_J46": "Asthma",
    "J60-J99": "Other respiratory diseases",
}
# Names of groups matched inside a code of the given chapters, in this order.
RANGE_GROUPS = (
    ("AB", "^A00-A08", "Intestinal infectious diseases"),
    ("AB", "^A09", "Other gastroenteritis and colitis"),
    ("AB", "A15-A19", "Tuberculosis"),
    ("AB", "^A40_A41", "Sepsis"),
    ("AB", "B15-B19", "Viral hepatitis"),
    ("AB", "^B20-B24", "HIV disease"),
    ("I", "^I20-I25", "Ischaemic heart diseases"),
    ("I", "^I60-I69", "Cerebrovascular diseases"),
)
# Chapter letters -> name shown as "<name> (<code>)".
CHAPTER_PATTERNS = {
    "J": "Respiratory disease",
    "AB": "Infectious disease",
    "CD": "Neoplasm",
    "I": "Circulatory disease",
    "K": "Digestive disease",
    "L": "Diseases of skin and subcutaneous tissue",
    "M": "Diseases of musculoskeletal system",
    "N": "Diseases of genitourinary system",
    "O": "Pregnancy, childbirth and puerperium",
    "P": "Conditions originating in perinatal period",
    "Q": "Congenital malformations",
    "R": "Symptoms, signs and abnormal findings",
    "ST": "Injury, poisoning and external causes",
    "Z": "Factors influencing health status",
}
# Chapter letters -> category. D and H are split further below.
CHAPTER_CATEGORIES = {
    "J": "respiratory",
    "AB": "infectious",
    "C": "neoplasms",
    "E": "endocrine_metabolic",
    "F": "mental_behavioural",
    "G": "nervous_system",
    "I": "circulatory",
    "K": "digestive",
    "L": "skin_subcutaneous",
    "M": "musculoskeletal",
    "N": "genitourinary",
    "O": "pregnancy_childbirth",
    "P": "perinatal",
    "Q": "congenital",
    "R": "symptoms_signs",
    "ST": "injury_poisoning",
    "Z": "health_factors",
    "VWXY": "external_causes",
}


def _per_letter(table: dict[str, str]) -> Column:
    pairs = [F.lit(x) for letters, value in table.items() for letter in letters for x in (letter, value)]
    return F.create_map(*pairs)


def _literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _stem(code: Column) -> Column:
    return F.regexp_replace(code, OTHER_SUFFIX + "$", "")


def _h_number(code: Column) -> Column:
    """Number behind the letter H (one or two digits); separates eye (below 60) from ear (to 95)."""
    digits = F.substring(_stem(code), 2, 2)
    return F.when(code.startswith("H") & digits.rlike("^[0-9]{1,2}$"), digits.try_cast("int"))


def icd10_name(code: Column) -> Column:
    stem = _stem(code)
    letter = F.substring(code, 1, 1)
    mark = F.when(code.endswith(OTHER_SUFFIX), " (other)").otherwise("")
    number = _h_number(code)

    aggregate = (
        F.when(code == ALL_CAUSES, "All causes of death")
        .when(F.upper(code) == ALL_CONDITIONS, ALL_CONDITIONS_NAME)
        .when(
            code.startswith(ALL_CONDITIONS),
            F.concat(F.lit(ALL_CONDITIONS_NAME + " - "), F.substring(code, 7, 1 << 20)),
        )
        .when(code == "J", "All respiratory diseases")
        .when(code == "J" + OTHER_SUFFIX, "Other respiratory conditions")
    )
    grouped = [F.concat(_literal_map(EXACT_GROUPS)[stem], mark)] + [
        F.when(letter.isin(*letters) & code.rlike(pattern), F.concat(F.lit(name), mark))
        for letters, pattern, name in RANGE_GROUPS
    ]
    eye_or_ear = F.when(number < 60, F.concat(F.lit("Diseases of eye and adnexa"), mark)).when(
        number.between(60, 95), F.concat(F.lit("Diseases of ear and mastoid process"), mark)
    )
    chapter = F.concat(_per_letter(CHAPTER_PATTERNS)[letter], F.lit(" ("), code, F.lit(")"))
    return F.coalesce(
        aggregate, *grouped, _literal_map(CHAPTER_NAMES)[stem], eye_or_ear, chapter, code
    )


def icd10_category(code: Column) -> Column:
    stem = _stem(code)
    letter = F.substring(code, 1, 1)
    number = _h_number(code)
    special = (
        F.when(code == ALL_CAUSES, "all_causes")
        .when((F.upper(code) == ALL_CONDITIONS) | code.startswith(ALL_CONDITIONS), "all_conditions")
        .when(stem == "J", "all_respiratory")
        .when(letter == "D", F.when(F.length(stem) <= 3, "neoplasms").otherwise("blood_immune"))
        .when(number < 60, "eye_adnexa")
        .when(number.between(60, 95), "ear_mastoid")
    )
    return F.coalesce(special, _per_letter(CHAPTER_CATEGORIES)[letter])


def icd10_description(name: Column, category: Column) -> Column:
    """``name (category with blanks)``, or the bare name where there is no category."""
    with_category = F.concat(name, F.lit(" ("), F.replace(category, F.lit("_"), F.lit(" ")), F.lit(")"))
    return F.coalesce(with_category, name)
