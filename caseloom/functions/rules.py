"""Rule tables for free-text names and the expressions that apply them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from caseloom.functions.scalars import _col

# --- Fixed values -----------------------------------------------------------

COVID_WORDS = ("COVID-19", "SARS-COV-2", "COVID", "COV-19")

JANSSEN_NAME = "COVID-19 vac, Ad26.COV2.S (Janssen)/PF"
MRNA_NAME = "COVID-19 vaccine, mRNA, BNT162b2, LNP-S (Pfizer)/PF"
ASTRA_NAME = "COVID-19 vaccine, AZD-1222 (AstraZeneca)/PF"
NON_US_NAME = "COVID-19, Non-US"
UNSPECIFIED_NAME = "COVID-19, Unspecified"

# (any of these substrings, resulting name); first match wins.
COVID_NAME_RULES = (
    (("JANSSEN", "JNJ", "JSN", "JOHNSON AND JOHNSON", "AD26"), JANSSEN_NAME),
    (("PFIZER", "MODERNA", "MRNA BNT-162B2", "NOVAVAX"), MRNA_NAME),
    (("RS-CHADOX1",), ASTRA_NAME),
    (("NON-US", "SINOVAC"), NON_US_NAME),
)
OTHER_NAME_RULES = (
    (("INFLUENZA", "FLU "), "Flu Vaccine Unspecified"),
    (("HEPATITIS B", "HEP B"), "Hepatitis B Vaccine Unspecified"),
    (("PNEUMOCOCCAL",), "Pneumococcal Vaccine - Unspecified"),
    (("RABIES",), "Rabies Vaccine, Unspecified"),
    (("ZOSTER",), "Zoster Vaccine, Unspecified"),
    (("YELLOW FEVER",), "yellow fever vaccine live/PF"),
    (("TYPHOID",), "typhoid vacc,live,attenuated"),
)
RHO_NAME = "RHO (D) IMMUNE GLOBULIN"
TDAP_NAME = "Acellular Pertussis-Diphtheria-Tetanus Toxoids Vaccine-Reduced (TDaP)"

MODERNA_DOSE = "100MCG/0.5ML"
MODERNA_WORDS = ("MRNA-1273", "MRNA 1273", "100 MCG OR 50 MCG DOSE")
PFIZER_DOSE = "30MCG/0.3ML"

# Brand labels a canonical name, or the description behind it, can stand for.
BRAND_BY_NAME = (
    (JANSSEN_NAME, "JNJ"),
    (ASTRA_NAME, "AstraZeneca"),
    (NON_US_NAME, "Non-US"),
    (UNSPECIFIED_NAME, "Unspecified"),
)
BRAND_BY_DESCRIPTION = (
    (("MODERNA",), "MODERNA"),
    (("PFIZER",), "PFIZER"),
    (("NOVAVAX",), "NOVAVAX"),
    (("JANSSEN",), "JNJ"),
)
BRANDS = ("AstraZeneca", "JNJ", "MODERNA", "NOVAVAX", "Non-US", "PFIZER", "Unspecified")

FLU_WORDS = ("flu ", "influenza")
FLU_LIVE = (
    "Influenza Live Vaccine",
    "influenza vaccine quadrivalent live 2020-2021 (2 yrs-49 yrs)",
)
FLU_INACTIVATED = (
    "flu vaccine quad 2020-2021(4 years and older)cell derived/PF",
    "Influenza Inactivated Vaccine",
)

# (feature, any of these substrings of the lower-case name)
ANTIGEN_RULES = (
    ("Pertussis", ("pertussis",)),
    ("Diphtheria", ("diphtheria",)),
    ("Haemophilus_B", ("haemophilus",)),
    ("Pneumococcal", ("pneumococcal",)),
    ("MMR", ("measles", "mumps", "rubella")),
    ("HPV", ("papillomavirus",)),
    ("VZV", ("zoster",)),
    ("Rabies", ("rabies",)),
    ("HEP_A", ("hepatitis a",)),
    ("HEP_B", ("hepatitis b",)),
    ("Palio", ("palio",)),
)

# (first code, last code, chapter) compared on the leading characters.
ICD10_CHAPTERS = (
    ("A00", "B99", "Certain infectious and parasitic diseases"),
    ("C00", "D49", "Neoplasms"),
    ("D50", "D89", "Diseases of the blood and blood-forming organs and certain disorders "
                   "involving the immune mechanism"),
    ("E00", "E89", "Endocrine, nutritional and metabolic diseases"),
    ("F01", "F99", "Mental, Behavioral and Neurodevelopmental disorders"),
    ("G00", "G99", "Diseases of the nervous system"),
    ("H00", "H59", "Diseases of the eye and adnexa"),
    ("H60", "H95", "Diseases of the ear and mastoid process"),
    ("I00", "I99", "Diseases of the circulatory system"),
    ("J00", "J99", "Diseases of the respiratory system"),
    ("K00", "K95", "Diseases of the digestive system"),
    ("L00", "L99", "Diseases of the skin and subcutaneous tissue"),
    ("M00", "M99", "Diseases of the musculoskeletal system and connective tissue"),
    ("N00", "N99", "Diseases of the genitourinary system"),
    ("O00", "O9A", "Pregnancy, childbirth and the puerperium"),
    ("P00", "P96", "Certain conditions originating in the perinatal period"),
    ("Q00", "Q99", "Congenital malformations, deformations and chromosomal abnormalities"),
    ("R00", "R99", "Symptoms, signs and abnormal clinical and laboratory findings, "
                   "not elsewhere classified"),
    ("S00", "T88", "Injury, poisoning and certain other consequences of external causes"),
    ("U00", "U85", "Codes for special purposes"),
    ("V00", "Y99", "External causes of morbidity"),
    ("Z00", "Z99", "Factors influencing health status and contact with health services"),
)
ICD9_CHAPTERS = (
    ("001", "139", "Infectious And Parasitic Diseases"),
    ("140", "239", "Neoplasms"),
    ("240", "279", "Endocrine, Nutritional And Metabolic Diseases, And Immunity Disorders"),
    ("280", "289", "Diseases Of The Blood And Blood-Forming Organs"),
    ("290", "319", "Mental Disorders"),
    ("320", "389", "Diseases Of The Nervous System And Sense Organs"),
    ("390", "459", "Diseases Of The Circulatory System"),
    ("460", "519", "Diseases Of The Respiratory System"),
    ("520", "579", "Diseases Of The Digestive System"),
    ("580", "629", "Diseases Of The Genitourinary System"),
    ("630", "679", "Complications Of Pregnancy, Childbirth, And The Puerperium"),
    ("680", "709", "Diseases Of The Skin And Subcutaneous Tissue"),
    ("710", "739", "Diseases Of The Musculoskeletal System And Connective Tissue"),
    ("740", "759", "Congenital Anomalies"),
    ("760", "779", "Certain Conditions Originating In The Perinatal Period"),
    ("780", "799", "Symptoms, Signs, And Ill-Defined Conditions"),
    ("800", "999", "Injury And Poisoning"),
    ("V01", "V91", "Supplementary Classification Of Factors Influencing Health Status And "
                   "Contact With Health Services"),
    ("E000", "E999", "Supplementary Classification Of External Causes Of Injury And Poisoning"),
)

# --- Expressions ------------------------------------------------------------

Rules = Sequence[tuple[Sequence[str], str]]


def contains_any(c: Column | str, words: Sequence[str]) -> Column:
    c = _col(c)
    return reduce(or_, [c.contains(word) for word in words])


def first_match(c: Column | str, rules: Rules, default: Column | None = None) -> Column:
    """Result of the first rule with a substring in ``c``, else ``default``."""
    chain = F
    for words, outcome in rules:
        chain = chain.when(contains_any(c, words), F.lit(outcome))
    return chain if default is None else chain.otherwise(default)


def is_covid(description: Column | str) -> Column:
    return contains_any(description, COVID_WORDS)


def annotate_brand(description: Column | str) -> Column:
    """Append the maker a dose or compound name gives away."""
    description = _col(description)

    def dose(text: Column, amount: str) -> Column:
        return F.replace(text, F.lit(" "), F.lit("")).contains(amount)

    moderna = dose(description, MODERNA_DOSE) | contains_any(description, MODERNA_WORDS)
    named = F.when(moderna, F.concat(description, F.lit(" (MODERNA)"))).otherwise(description)
    return F.when(dose(named, PFIZER_DOSE), F.concat(named, F.lit("(PFIZER)"))).otherwise(named)


def vaccine_name(description: Column | str) -> Column:
    """Canonical name for an upper-case description."""
    description = _col(description)
    covid = first_match(annotate_brand(description), COVID_NAME_RULES, F.lit(UNSPECIFIED_NAME))
    squeezed = F.replace(description, F.lit(" "), F.lit(""))
    rest = (
        F.when(squeezed.contains("RHO(D)") | description.contains("RHO D "), F.lit(RHO_NAME))
        .when(description.contains("TDAP"), F.lit(TDAP_NAME))
        .otherwise(description)
    )
    return F.when(is_covid(description), covid).otherwise(
        first_match(description, OTHER_NAME_RULES, rest)
    )


def covid_brand(name: Column | str, description: Column | str) -> Column:
    """Brand label of a COVID vaccine; null for any other name."""
    name = _col(name)
    by_description = first_match(description, BRAND_BY_DESCRIPTION, F.lit("Unspecified"))
    chain = F.when(name == MRNA_NAME, by_description)
    for canonical, brand in BRAND_BY_NAME:
        chain = chain.when(name == canonical, F.lit(brand))
    return F.when(name.contains("COVID-19"), chain.otherwise(F.lit("Unspecified")))


def flu_kind(name: Column | str, strict: bool = False) -> Column:
    """Live, Inactivated or Unspecified for flu vaccines, null otherwise.

    The word test also accepts Haemophilus influenzae; ``strict`` refuses it.
    """
    name = _col(name)
    lower = F.lower(name)
    about_flu = contains_any(lower, FLU_WORDS)
    if strict:
        about_flu = about_flu & ~lower.contains("haemophilus")
    kind = (
        F.when(name.isin(*FLU_LIVE), F.lit("Live"))
        .when(name.isin(*FLU_INACTIVATED), F.lit("Inactivated"))
        .otherwise(F.lit("Unspecified"))
    )
    return F.when(about_flu, kind)


def substring_flags(
    c: Column | str, rules: Sequence[tuple[str, Sequence[str]]] = ANTIGEN_RULES
) -> dict[str, Column]:
    """One 0/1 column per rule, matched without regard to case."""
    lower = F.lower(_col(c))
    return {
        feature: F.coalesce(contains_any(lower, words), F.lit(False)).cast("int")
        for feature, words in rules
    }


def code_range_chapter(code: Column | str, system: str) -> Column:
    """Chapter title whose code range holds the leading characters of ``code``."""
    code = _col(code)
    chain = F
    for first, last, title in {"ICD10": ICD10_CHAPTERS, "ICD9": ICD9_CHAPTERS}[system]:
        lead = F.substring(code, 1, len(first))
        chain = chain.when(lead.between(first, last), F.lit(title))
    return chain
