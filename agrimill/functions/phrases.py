"""Usage phrases of a plant-protection catalogue: ``crop*application*target``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from agrimill.functions.text import capitalize, contains_any, replace_all

# Words whose phrase keeps everything after the first star as the target.
WHOLE_TAIL = ("Désherbage", "Dévitalisation", "Trt Sol*Avt Plantation")

# Crop labels left in their own case, then the replacements applied.
CASE_EXEMPT = ("PPAM", "Porte graine")
CROP_FIXES = (
    ("graminees", "graminées"), ("écossées", "écossés"), (" - abricotier", ""),
    ("Chataignier", "Châtaignier"), ("Mais", "Maïs"),
)

# Target names with one accepted spelling, then words with a set case.
TARGET_SYNONYMS = (
    (("RHIZOCTONIA", "Rhizoctoniose"), "Rhizoctone"),
    (("SCLEROTINIA",), "Sclérotiniose"),
)
TARGET_CAPITALS = ("floraison", "ramification", "hybridation", "naturelles")
TARGET_LOWERS = ("Ensilage", "Grains")


def usage_phrase(col: Column) -> tuple[Column, Column, Column]:
    """(crop, application, target) of a usage phrase."""
    parts = F.split(col, r"\*", F.when(contains_any(col, WHOLE_TAIL), 2).otherwise(-1))
    application = F.when(F.size(parts) > 2, F.get(parts, 1))
    target = F.when(F.size(parts) > 2, F.get(parts, 2)).otherwise(F.get(parts, 1))
    return F.get(parts, 0), application, target


def clean_crop(col: Column) -> Column:
    """Crop label with one spelling."""
    cased = F.when(contains_any(col, CASE_EXEMPT), col).otherwise(capitalize(col))
    return F.rtrim(replace_all(cased, CROP_FIXES))


def clean_target(col: Column) -> Column:
    """Target label with one spelling and no brackets, dashes or numbering."""
    out = F.when(F.startswith(col, F.lit(" ")), F.substr(col, F.lit(2))).otherwise(col)
    for names, kept in TARGET_SYNONYMS:
        out = F.when(out.isin(*names), F.lit(kept)).otherwise(out)
    raised = F.concat(F.upper(F.substring(out, 1, 1)), F.substr(out, F.lit(2)))
    out = F.when(
        out == F.upper(out), F.replace(capitalize(out), F.lit("couronnee"), F.lit("couronnée"))
    ).otherwise(raised)
    out = replace_all(out, ((")", ""), (" ( ", " "), ("(", ""), (" 1", ""), ("-", " ")))
    out = replace_all(out, [(w, w.capitalize()) for w in TARGET_CAPITALS])
    out = replace_all(out, [(w, w.lower()) for w in TARGET_LOWERS])
    out = replace_all(out, (("ion sur la", "."),))
    out = F.regexp_replace(out, r"[ .]\z", "")
    return F.regexp_replace(out, r"\.(?=[^ ])", ". ")
