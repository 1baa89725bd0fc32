"""Tactic codes, engagement tiers, areas, segments and buckets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.scalar import after_bar, column, flag_letter, like_any, like_escape, yes_no

# Code lengths kept by the tactic parsers (fixed values).
CAMPAIGN_LENGTH = 11
HOUSE_LENGTH = 12


def tactic_code(source: Column | str, tactic: Column | str, fold: bool = True) -> Column:
    """Code without its suffix.  ``fold`` upper-cases first; the definition table is matched
    on the unfolded form."""
    return _cut_code(source, tactic, V.TACTIC_CAMPAIGN, V.TACTIC_HOUSE, fold)


def original_tactic(source: Column | str, tactic: Column | str) -> Column:
    """Code of the mailing that a resend repeats; other codes stay as they are."""
    return _cut_code(source, tactic, V.TACTIC_CAMPAIGN_RESEND, V.TACTIC_HOUSE_RESEND, True)


def _cut_code(source, tactic, campaign: str, house: str, fold: bool) -> Column:
    source, tactic = column(source), column(tactic)
    text = F.upper(tactic) if fold else tactic
    mailed = F.upper(source) == "SFMC"
    return (F.when(mailed & like_escape(text, campaign), F.substring(text, 1, CAMPAIGN_LENGTH))
            .when(mailed & like_escape(text, house), F.substring(text, 1, HOUSE_LENGTH))
            .otherwise(tactic))


def resend_flag(source: Column | str, tactic: Column | str) -> Column:
    up = F.upper(column(tactic))
    return yes_no((F.upper(column(source)) == "SFMC")
                  & (like_escape(up, V.TACTIC_CAMPAIGN_RESEND) | like_escape(up, V.TACTIC_HOUSE_RESEND)))


def base_tactic(tactic: Column | str, tested: Column | None = None) -> Column:
    tactic = column(tactic)
    tested = tactic if tested is None else tested
    return (F.when(tested.like(V.TACTIC_HOUSE_ANY), F.substring(tactic, 1, HOUSE_LENGTH))
            .otherwise(F.substring(tactic, 1, CAMPAIGN_LENGTH)))


def engagement_tier(deep: Column, light: Column, contacted: Column) -> Column:
    """Deepest tier whose condition holds; NULL when none does."""
    return (F.when(deep, "Deep Engagement").when(light, "Light Engagement")
            .when(contacted, "Contacted"))


def tier_columns(deep: str, light: str, contacted: str, cae: str) -> dict[str, Column]:
    """Flag letters plus tier from '1'-coded definition columns."""
    on = {name: F.col(name) == "1" for name in (deep, light, contacted)}
    return {
        "deep_engagement_flag": flag_letter(deep),
        "light_engagement_flag": flag_letter(light),
        "contacted_flag": flag_letter(contacted),
        "cae_flag": flag_letter(cae),
        "engagement_type": engagement_tier(on[deep], on[light], on[contacted]),
        "light_deep_engagement_flag": yes_no(on[deep] | on[light]),
    }


def unsubscribe_click(id_type: Column | str, id_value: Column | str) -> Column:
    return yes_no((F.upper(column(id_type)) == "URL")
                  & like_any(F.upper(column(id_value)), V.UNSUBSCRIBE_URLS))


def firewall_click(name: Column | str, value: Column | str) -> Column:
    return yes_no((F.upper(column(name)) == "FIREWALL_FLAG") & (F.upper(column(value)) == "Y"))


def area_of(product: Column | str, display: Column | str, declared: Column | str) -> Column:
    """Area by product name; unknown products fall back to the text after '|' in their display
    name, then to the declared area, then to the product itself."""
    product, display = F.upper(column(product)), column(display)
    return (F.when(product.isin(V.MS_BRANDS), V.AREA_MS)
            .when(product.isin(V.SMA_BRANDS), V.AREA_SMA)
            .when(product.isin(V.ALZ_BRANDS) | product.like("%ALZ%"), V.AREA_ALZ)
            .when(product == V.FRANCHISE_NEURO, V.FRANCHISE_NEURO)
            .when(display.contains("|"), after_bar(F.upper(display)))
            .otherwise(F.coalesce(F.upper(column(declared)), product)))


def renamed(c: Column | str, names: Mapping[str, str]) -> Column:
    """Upper-cased value with a few of them replaced."""
    up, out = F.upper(column(c)), None
    for old, new in names.items():
        out = F.when(up == old, new) if out is None else out.when(up == old, new)
    return out.otherwise(up)


def program_of(product: Column | str) -> Column:
    product = column(product)
    return (F.when(product == V.AREA_MS, V.MS_PROGRAM)
            .when(product == V.AREA_SMA, V.SMA_PROGRAM).otherwise(product))


def area_group(parent: Column | str) -> Column:
    parent = column(parent)
    return F.when(parent.isin(V.HEM_PARENT_AREAS), "HEM").when(parent.isin(V.MS_PARENT_AREAS), "MS")


# Segment wording per role (fixed values, misspelling included).
_BANDS = [("Pediatric Patient", 13, "AGE_RANGE_0_12"), ("Adolscent Patient", 18, "AGE_RANGE_13_17")]
_ROLES = {"CAREGIVER": ("Caregiver of ", "Other Caregivers"), "PATIENT": ("", "Other Patients")}


def patient_segment(role: Column | str, age: Column | str, survey: Column | str,
                    web_registered: Column | str) -> Column:
    """Age band per role, from the known age or else the survey answer; then web registration."""
    role, age, survey = F.upper(column(role)), column(age), column(survey)
    web = column(web_registered) == 1
    out = F
    for name, (prefix, rest) in _ROLES.items():
        mine = role == name
        for label, below, answer in _BANDS:
            out = out.when(mine & ((age < below) | (age.isNull() & (survey == answer))), prefix + label)
        out = (out.when(mine & ((age >= 18) | (age.isNull() & (survey == "AGE_RANGE_ADULT"))),
                        prefix + "Adult Patient")
               .when(mine & web, rest + " who are Web-Registered")
               .when(mine, rest + " and not Web-Registered"))
    return (out.when(~role.isin(*_ROLES) & web, "Others who are Web-Registered")
            .otherwise("Others who are not Web-Registered"))


def journey_stage(first_injection: Column | str, referral: Column | str) -> Column:
    return (F.when(column(first_injection).isNotNull(), "Retention")
            .when(column(referral).isNotNull(), "Queued").otherwise("Acquisition"))


# Decile text -> group label (fixed values).
DECILE_GROUPS = {("10", "9", "8"): "8-10 DECILE", ("7", "6", "5"): "5-7 DECILE",
                 ("4", "3"): "3-4 DECILE", ("2", "1"): "1-2 DECILE", ("0",): "0 DECILE"}


def decile_group(decile: Column | str) -> Column:
    out = F
    for members, label in DECILE_GROUPS.items():
        out = out.when(column(decile).isin(*members), label)
    return out.otherwise("NO DECILE")


def segment_priority(segment: Column | str) -> Column:
    return (F.when(column(segment).isin("N1", "N2", "P1"), "Priority1")
            .when(column(segment).isin("N3", "N4", "P2", "P3"), "Priority2"))


def affiliation_label(name: Column | str, kind: Column | str) -> Column:
    name, kind = F.upper(column(name)), F.upper(column(kind))
    out = F.when((name == "AD_PRIMARY_AFFILIATION__C") & (kind == "Y"), "PRIMARY AD AFFILIATION")
    for site, words in V.AFFILIATION_SITES.items():
        for code, rank in V.AFFILIATION_RANKS.items():
            out = out.when((name == site) & (kind == code), f"{rank} AD {words} LOCATION")
    return out


def vendor_weight(vendor: Column | str) -> Column:
    up = F.upper(column(vendor))
    return F.when(up == "VEEVA", 1).when(up == "SFMC", 2).otherwise(0)


def audience_code(weight_sum: Column | str) -> Column:
    """Field only, electronic only, both, or neither."""
    c = column(weight_sum)
    return F.when(c == 1, "F").when(c == 2, "E").when(c == 3, "B").otherwise("")
